"""Tables in their declared columns and types."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from planutil import plan_text
from vigia.cli import main
from vigia.operators import declared as T
from vigia.plans import etl, versions
from vigia.plans import views as V
from vigia.session import fresh_dir
from vigia.sources.fixture import raw_notifications

SF = "/root/testdata/sf0.001"
SPARK = {"SMALLINT": "smallint", "INT": "int", "BIGINT": "bigint", "BOOLEAN": "boolean", "DATE": "date",
         "NUMERIC(5,2)": "decimal(5,2)"}


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def base(spark):
    out = etl.build_warehouse(spark, raw_notifications(spark, SF), root=fresh_dir(spark, "declared"), buckets=4)
    yield out
    out.close(spark)


def test_export_has_the_declared_schema_and_every_row(spark, base, capsys):
    out = fresh_dir(spark, "declared_out")
    main(["export", "--warehouse", base.root, "--out", out])
    t = {n: spark.read.parquet(f"{out}/{n}") for n in T.DECLARED}
    for name, df in t.items():
        want = [(c, SPARK.get(d, "string")) for c, d in T.declared_types(name).items()]
        assert df.dtypes == want, name
        assert df.count() == base[name].count(), name
    tests = t["fato_testes_realizados"]
    assert tests.select("id_registro").distinct().count() == tests.count()
    for view in (V.cases_by_municipality, V.frequent_symptoms, V.laboratory_analysis, V.positivity_rate):
        assert _rows(view(t)) == _rows(view(base.tables)), view.__name__
    with pytest.raises(PySparkException):  # never written over
        T.write_declared(base.tables, out)


def test_projection_is_narrow(base):
    for name in etl.FACTS:
        assert "Exchange" not in plan_text(T.as_declared(base[name], name))


def test_record_ids_outlive_deletes(spark, base):
    ids = base["fato_notificacoes"].filter("id_notificacao % 3 = 0").select("id_notificacao")
    new = versions.delete_notifications(spark, base, ids, root=fresh_dir(spark, "declared"))
    name = "fato_testes_realizados"
    kept = T.as_declared(base[name].filter("fk_notificacao % 3 <> 0"), name)
    assert _rows(T.as_declared(new[name], name)) == _rows(kept)
    new.close(spark)


@pytest.mark.parametrize(("column", "value", "said"), [
    ("codigo_recebeu_vacina", "32768L", "SMALLINT"), ("codigo_recebeu_vacina", "-32769L", "SMALLINT"),
    ("idade", "2147483648L", "INT"), ("sexo", "repeat('é', 21)", "VARCHAR"), ("data_notificacao", "NULL", "NULL")])
def test_values_that_do_not_fit_raise(spark, base, column, value, said):
    fact = base["fato_notificacoes"]
    first = fact.agg(F.min("id_notificacao")).first()[0]
    bad = fact.withColumn(column, F.when(F.col("id_notificacao") == first, F.expr(value)).otherwise(F.col(column)))
    assert [tuple(r) for r in T.misfits(bad, "fato_notificacoes").collect()] == [(column, 1)]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(PySparkException, match=f"fato_notificacoes.{column}.*{said}"):
                T.as_declared(bad, "fato_notificacoes").collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_bounds_fit_and_empty_tables(spark, base):
    fact = base["fato_notificacoes"]
    edge = fact.limit(1).withColumns({"codigo_recebeu_vacina": F.lit(-32768), "idade": F.lit(2147483647).cast("bigint"),
                                      "sexo": F.lit("é" * 20), "more": F.lit(1)})
    row = T.as_declared(edge, "fato_notificacoes").first()
    assert (row.codigo_recebeu_vacina, row.idade, row.sexo) == (-32768, 2147483647, "é" * 20) and "more" not in row
    assert T.misfits(edge, "fato_notificacoes").count() == 0
    assert T.as_declared(fact.limit(0), "fato_notificacoes").count() == 0
    assert T.misfits(fact.limit(0), "fato_notificacoes").count() == 0
    tests = spark.createDataFrame([(0, 1), ], "fk_notificacao long, test_number int")
    with pytest.raises(PySparkException, match="id_registro"):
        T.as_declared(tests, "fato_testes_realizados").collect()
