from pyspark.sql import functions as F

from vigia.functions import dates
from vigia.plans.catalog import queries
from vigia.session import compiled_methods
from vigia.sources import csv as S


SMALL = "/root/testdata/sf0.001"
KEY = "spark.sql.codegen.hugeMethodLimit"


def test_wide_projections_are_generated_as_methods_that_the_jvm_compiles(spark):
    spark.conf.unset(KEY)
    queries()["impute_class"](spark, SMALL)
    assert spark.conf.get(KEY) == "8000"
    spark.conf.set(KEY, "9000")  # a setting of the session's own stays
    compiled_methods(spark)
    assert spark.conf.get(KEY) == "9000"
    spark.conf.unset(KEY)
    compiled_methods(spark)


def test_usual_cells_are_cast_and_all_read_as_the_formats_do(spark):
    cells = ["1/2/2020", "31/02/2020", "29/2/2024", "29/2/2023", "0/1/2020", "1/13/2020", "1/1/0000", "1/1/0001",
            "2020-1-2", "2020-02-30", "2020-01-02T03:04:05", "2020-1-2 3:4:5.25", "2020-01-02 24:00:00", "0000-01-01",
             "2020-01-01\n", "1/1/2020\n", " 1/1/2020 ", "1/1/20", "5", "", None, "2020-01-02T03:04:05Z", "1/2/2020 3:04"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    fast, general = (dates.parse_day_first(F.col("c"), f) for f in (None, dates.DAY_FIRST_FORMATS))
    rows = df.select("c", fast.cast("string").alias("a"), general.cast("string").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]
    # a usual cell is no exception of a format that doesn't fit
    assert "RLIKE" in df.select(fast)._jdf.queryExecution().optimizedPlan().toString()


def test_plain_digits_are_typed_as_decimals_are(spark):
    cells = ["5", "-7", "007", "5.0", "1e3", "1.5", "99999999999999999", "9223372036854775808", "+5", "5\n", "", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    exact = F.col("c").try_cast("decimal(38,10)")
    for kind in ("bigint", "int"):
        typed = df.select("c", S.typed_number(F.col("c"), kind).alias("a"))
        rows = typed.select("a", F.when(exact % 1 == 0, exact.try_cast(kind)).alias("b")).collect()
        assert [r.a for r in rows] == [r.b for r in rows]
        assert "RLIKE" in typed._jdf.queryExecution().optimizedPlan().toString()


def test_tables_of_whole_buckets_are_written_without_a_sort(spark, tmp_path):
    from vigia.plans import etl
    from vigia.sources.fixture import raw_notifications

    before = spark.conf.get(etl.WRITERS_CONF)
    seen = []
    put = etl._Steps.put

    def spy(self, *args, **kwargs):
        seen.append(spark.conf.get(etl.WRITERS_CONF))
        return put(self, *args, **kwargs)

    etl._Steps.put = spy
    try:
        wh = etl.build_warehouse(spark, raw_notifications(spark, SMALL), root=str(tmp_path), buckets=3)
    finally:
        etl._Steps.put = put
    assert set(seen) == {str(etl.OPEN_WRITERS)} and spark.conf.get(etl.WRITERS_CONF) == before
    for parts in wh.parts.values():
        assert len(parts) == 3
    wh.close(spark)
