"""New versions of a published warehouse: stored cascade, further loads."""

import pytest
from pyspark.sql import functions as F

from planutil import plan_text
from vigia.operators import quality as Q
from vigia.plans import etl, versions
from vigia.plans import views as V
from vigia.session import fresh_dir, list_names
from vigia.sources.fixture import raw_notifications

SF = "/root/testdata/sf0.001"
DATED = [n for n in etl.DIMENSIONS + etl.FACTS if n != "dim_localidades"]


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def raw(spark):
    return raw_notifications(spark, SF)


@pytest.fixture(scope="module")
def base(spark, raw):
    out = etl.build_warehouse(spark, raw, root=fresh_dir(spark, "versions"), buckets=8)
    yield out
    out.close(spark)


def test_a_delete_rewrites_only_the_buckets_it_touches(spark, base):
    fact = base["fato_notificacoes"]
    group = etl.bucket_group(F.col("id_notificacao"), 8)
    doomed = fact.filter(group == 3).orderBy("id_notificacao").limit(5).select("id_notificacao")
    ids = {r[0] for r in doomed.collect()}
    # repeated, unknown and NULL ids change nothing
    odd = doomed.unionByName(doomed).unionByName(spark.createDataFrame([(-1,), (None,)], doomed.schema))
    new = versions.delete_notifications(spark, base, odd, root=fresh_dir(spark, "versions"))
    for name, (_, key) in etl.BUCKETED.items():
        old, now = set(base.parts[name]), set(new.parts[name])
        assert {p for p in old - now} == {p for p in old if p.endswith("_parte=3")}  # the others by name
        assert all(p.startswith(new.run) for p in now - old)
        assert _rows(new[name]) == _rows(base[name].filter(~F.col(key).isin(ids))), name
        assert _rows(base[name].filter(F.col(key).isin(ids))), name  # readers keep their version
    reopened = etl.load_warehouse(spark, new.root)
    for name in etl.FACTS + etl.INDICATORS:
        assert _rows(reopened[name]) == _rows(new[name]), name
    assert not Q.load_gate_violations({n: reopened[n] for n in etl.DIMENSIONS + etl.FACTS + etl.INDICATORS}).count()
    assert versions.delete_notifications(spark, reopened, odd) is reopened  # repeated: nothing left to do
    # views of the new version join bucket by bucket
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = reopened["fato_notificacao_sintoma"].join(reopened["fato_notificacoes"].select("id_notificacao"),
                                                      F.col("fk_notificacao") == F.col("id_notificacao"))
        assert "Exchange" not in plan_text(j)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    reopened.close(spark), new.close(spark)


def test_deleting_everything_leaves_empty_tables(spark, base):
    new = versions.delete_notifications(spark, base, base["fato_notificacoes"], root=fresh_dir(spark, "versions"))
    again = etl.load_warehouse(spark, new.root)
    for name in etl.BUCKETED:
        assert again.parts[name] == [] and again[name].count() == 0 and again[name].columns == base[name].columns
    assert V.cases_by_municipality(again.tables).count() == 0
    again.close(spark), new.close(spark)


def test_two_loads_equal_one_load_of_both(spark, raw, base):
    cut = raw.agg(F.expr("percentile_approx(id_notificacao, 0.6)")).first()[0]
    root = fresh_dir(spark, "versions")
    ages = raw.withColumn("idade", F.coalesce("idade", F.lit(base.median_age)).cast(raw.schema["idade"].dataType))
    first = etl.build_warehouse(spark, ages.filter(F.col("id_notificacao") <= cut), root=root, buckets=8)
    second = versions.append_notifications(spark, first, ages.filter(F.col("id_notificacao") > cut), load="second")
    for name in [n for n in DATED if n != "fato_notificacoes"]:
        assert _rows(second[name]) == _rows(base[name]), name
    place = lambda wh: wh["fato_notificacoes"].join(
        wh["dim_localidades"].select(F.col("id_localidade").alias("fk_localidade_residencia"), "codigo_ibge_municipio"),
        "fk_localidade_residencia", "left").drop("fk_localidade_residencia")
    assert _rows(place(second)) == _rows(place(base))
    for name in etl.DIMENSIONS:  # known ids are unchanged
        assert set(_rows(first[name])) <= set(_rows(second[name])), name
    for view, fn in V.VIEWS.items():
        assert _rows(fn(second.tables)) == _rows(fn(base.tables)), view
    # no file of the first load was written again
    assert all(set(first.parts[n]) <= set(second.parts[n]) for n in etl.BUCKETED)
    # the same load again: not loaded; under another name its ids are there already, and nothing is left behind
    again = etl.load_warehouse(spark, root)
    assert versions.append_notifications(spark, again, ages, load="second") is again
    runs, names = list_names(spark, f"{root}/runs"), {t.name for t in spark.catalog.listTables()}
    with pytest.raises(Q.IntegrityError):
        versions.append_notifications(spark, again, ages.filter(F.col("id_notificacao") > cut), load="third")
    assert list_names(spark, f"{root}/runs") == runs and {t.name for t in spark.catalog.listTables()} == names
    # a change that starts from an older version doesn't undo the newer one
    with pytest.raises(versions.VersionConflict):
        versions.delete_notifications(spark, first, ages.limit(1))
    # the first version may go: its folders, still in use, stay
    assert etl.remove_old_runs(spark, root, keep=1) == [first.version]
    last = etl.load_warehouse(spark, root)
    assert _rows(last["fato_testes_realizados"]) == _rows(base["fato_testes_realizados"])
    for w in (first, second, again, last):
        w.close(spark)


def test_a_renumbered_load_follows_the_ids_that_are_there(spark, raw, base):
    few = raw.filter(F.col("id_notificacao") <= 40)
    new = versions.append_notifications(spark, base, few, renumber=True, root=fresh_dir(spark, "versions"))
    top = base["fato_notificacoes"].agg(F.max("id_notificacao")).first()[0]
    added = new["fato_notificacoes"].filter(F.col("id_notificacao") > top)
    assert added.count() == new.rows["clean"] == base["fato_notificacoes"].filter("id_notificacao <= 40").count() > 0
    new.close(spark)
