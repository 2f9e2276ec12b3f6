"""Safe publish: run folders, one pointer, nothing lost when a gate fails."""

import pytest
from pyspark.sql import functions as F

from vigia.operators import quality as Q
from vigia.operators.clean import exact_median
from vigia.plans import etl
from vigia.session import fresh_dir, list_names


def test_a_failing_gate_leaves_the_published_version(spark, wh):
    root = fresh_dir(spark, "publish")
    first = etl.build_warehouse(spark, wh["clean"], root=root)
    before = first["fato_notificacoes"].count()
    tables = {t.name for t in spark.catalog.listTables()}
    bad = wh["clean"].withColumn("idade", F.when(F.col("id_notificacao") == 1, F.lit(-5)).otherwise(F.col("idade")))
    with pytest.raises(Q.IntegrityError):
        etl.build_warehouse(spark, bad, root=root)
    assert {t.name for t in spark.catalog.listTables()} == tables  # and no catalog entry is left behind
    now = etl.load_warehouse(spark, root)
    assert now.run == first.run and now["fato_notificacoes"].agg(F.min("idade")).first()[0] >= 0
    assert now["fato_notificacoes"].count() == before and len(list_names(spark, f"{root}/runs")) == 1
    now.close(spark)
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_readers_see_one_version_and_old_runs_can_go(spark, wh):
    root = fresh_dir(spark, "publish")
    half = wh["clean"].filter("id_notificacao % 2 = 0")
    first = etl.build_warehouse(spark, half, root=root)
    reader = etl.load_warehouse(spark, root)
    etl.build_warehouse(spark, wh["clean"], root=root)
    assert reader["fato_notificacoes"].count() == first.rows["fato_notificacoes"]  # still its own version
    assert etl.load_warehouse(spark, root)["fato_notificacoes"].count() == wh["fato_notificacoes"].count()
    assert len(etl.remove_old_runs(spark, root, keep=1)) == 1 and len(list_names(spark, f"{root}/runs")) == 1


def test_input_without_any_date_raises(spark, wh):
    none = wh["clean"].withColumn("dataNotificacao", F.lit(None).cast("timestamp_ntz"))
    root = fresh_dir(spark, "publish")
    with pytest.raises(Q.IntegrityError):
        etl.build_warehouse(spark, none, root=root, gate=False)
    with pytest.raises(FileNotFoundError):
        etl.load_warehouse(spark, root)


@pytest.mark.parametrize("values", [[], [None], [3.0], [1.0, 2.0], [5.0, 1.0, 3.0, None], list(range(100)), [7.0] * 9 + [1.0]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    known = sorted(v for v in values if v is not None)
    want = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2 if known else None
    for most in (100_000, 3):  # on both sides of the narrowing
        assert exact_median(df, "v", most) == want


def test_buckets_follow_the_input(spark, wh):
    assert etl.default_buckets(spark, wh["clean"]) == max(1, spark.sparkContext.defaultParallelism)
    assert etl.input_bytes(wh["clean"]) > 0


def test_buckets_of_an_input_of_unknown_size(spark, wh):
    raw = spark.createDataFrame(wh["clean"].limit(50).collect(), wh["clean"].schema)
    for df in (raw, spark.createDataFrame(raw.rdd, raw.schema)):
        assert etl.input_bytes(df) is None
        assert etl.default_buckets(spark, df) == max(1, spark.sparkContext.defaultParallelism)
    built = etl.build_warehouse(spark, raw)
    assert built["fato_notificacoes"].count() == 50
    built.close(spark)
    old = etl.BUCKET_BYTES
    try:
        etl.BUCKET_BYTES = 1  # an enormous input
        assert etl.default_buckets(spark, wh["clean"]) <= 100_000
    finally:
        etl.BUCKET_BYTES = old
