import pytest
from pyspark.sql import functions as F

from vigia.operators import quality as Q


def test_rules(spark):
    df = spark.createDataFrame([(1, None, -1), (1, "x", 5), (None, "y", None)], "id long, name string, age int")
    nn = Q.not_null_violations(df, "t", ["id"], ["name", "id"])
    assert sorted((r.key, r.detail) for r in nn.collect()) == [("1", "name"), ("NULL", "id")]
    un = Q.unique_violations(df, "t", ["id"])
    assert [(r.key, r.detail) for r in un.collect()] == [("1", "rows=2")]
    ck = Q.check_violations(df, "t", ["id"], {"age >= 0": F.col("age") >= 0})
    assert [r.key for r in ck.collect()] == ["1"]  # NULL age passes
    fit = Q.type_fit_violations(df, "t", ["id"], {"name": ("varchar", 0)})
    assert fit.count() == 2


def test_orphans_and_cascade(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1, 10), (3, 11), (None, 12)], "fk long, k long")
    orphans = Q.orphan_violations(child, "c", ["k"], "fk", parent, "id", "p")
    assert [r.key for r in orphans.collect()] == ["11"]
    deleted = spark.createDataFrame([(1,)], "id long")
    kept = Q.cascade_delete({"c": (child, "fk")}, deleted, "id")["c"]
    assert sorted(r.k for r in kept.collect()) == [11, 12]


def test_gate_fails(spark):
    df = spark.createDataFrame([(1,), (1,)], "id long")
    with pytest.raises(Q.IntegrityError):
        Q.gate(Q.unique_violations(df, "t", ["id"]), mode="fail")


def test_warehouse_is_clean(wh):
    assert Q.warehouse_violations(wh.tables).count() == 0


def test_quarantine_splits_rows(spark):
    df = spark.createDataFrame([(1, -1), (2, 5), (3, None)], "id long, age int")
    v = Q.check_violations(df, "t", ["id"], {"age >= 0": F.col("age") >= 0})
    good, bad = Q.quarantine(df, v, "t")
    assert sorted(r.id for r in good.collect()) == [2, 3]
    assert [r.id for r in bad.collect()] == [1]


def test_hidden_rows_reported(wh):
    hidden = Q.hidden_from_views(wh["fato_notificacoes"]).count()
    assert hidden == wh.rows["fact_without_residence"] == 30


def test_gate_modes(spark, wh):
    import pytest
    from vigia.plans.etl import build_warehouse
    # a negative age breaks the CHECK rule of the fact
    bad = wh["clean"].withColumn("idade", F.when(F.col("id_notificacao") == 1, F.lit(-5)).otherwise(F.col("idade")))
    with pytest.raises(Q.IntegrityError):
        build_warehouse(spark, bad, gate="fail")
    rep = build_warehouse(spark, bad, gate="report")
    got = [(r.rule, r.key, r.detail) for r in rep["_violations"].collect()]
    assert got == [("check", "1", "idade >= 0")] and rep.rows["_violations"] == 1
    with pytest.raises(ValueError):
        build_warehouse(spark, bad, gate="sometimes")


def test_rules_on_absent_columns_give_no_rows(spark):
    df = spark.createDataFrame([(1,)], "id long")
    assert Q.not_null_violations(df, "t", ["id"], ["missing"]).count() == 0
    assert Q.type_fit_violations(df, "t", ["id"], {"missing": ("varchar", 2)}).count() == 0


def test_quarantine_matches_the_columns_a_rule_names(spark):
    df = spark.createDataFrame([(1, 5, "x"), (2, 5, "y"), (5, 7, "z"), (6, None, "NULL"), (7, None, None)],
                               "id long, code long, name string")
    v = Q.unique_violations(df, "t", ["code"]).unionByName(Q.not_null_violations(df, "t", ["name"], ["name"]))
    good, bad = Q.quarantine(df, v, "t")
    assert sorted(r.id for r in good.collect()) == [5, 6] and sorted(r.id for r in bad.collect()) == [1, 2, 7]


def test_quarantine_keys_with_separators_stay_apart(spark):
    df = spark.createDataFrame([("a|b", "c", -1), ("a", "b|c", 1)], "k string, l string, n int")
    good, bad = Q.quarantine(df, Q.check_violations(df, "t", ["k", "l"], {"n >= 0": F.col("n") >= 0}), "t")
    assert [r.k for r in good.collect()] == ["a"] and [r.k for r in bad.collect()] == ["a|b"]


def test_rules_of_the_seed_indicator_and_log_tables(spark):
    types = spark.createDataFrame([(1, "a"), (1, "a"), (40000, None)], "id_tipo_teste int, descricao_tipo_teste string")
    rate = spark.createDataFrame([(1, 99, None, 1000.0), (2, 99, None, 10.0)],
                                 "id_indicador int, fk_localidade int, data_referencia date, taxa_positividade double")
    log = spark.createDataFrame([(1, None, "TRUNCATE ALL")], "id_log long, tabela_afetada string, operacao string")
    places = spark.createDataFrame([(1, 1501402)], "id_localidade int, codigo_ibge_municipio int")
    found = Q.warehouse_violations({"dim_tipos_testes": types, "indicadores_municipais": rate, "log_alteracoes": log,
                                    "dim_localidades": places}).collect()
    got = {(r.rule, r.table_name, r.detail) for r in found}
    assert {("unique", "dim_tipos_testes", "rows=2"), ("type_fit", "dim_tipos_testes", "id_tipo_teste:smallint"),
            ("not_null", "dim_tipos_testes", "descricao_tipo_teste"),
            ("not_null", "indicadores_municipais", "data_referencia"),
            ("type_fit", "indicadores_municipais", "taxa_positividade:numeric(5,2)"),
            ("foreign_key", "indicadores_municipais", "fk_localidade->dim_localidades.id_localidade"),
            ("not_null", "log_alteracoes", "tabela_afetada"),
            ("type_fit", "log_alteracoes", "operacao:varchar(10)")} <= got


def test_gate_quarantine_moves_rows_and_what_hangs_on_them(spark, wh):
    from vigia.plans.etl import build_warehouse, load_warehouse
    from vigia.session import fresh_dir
    bad = wh["clean"].withColumn("idade", F.when(F.col("id_notificacao") == 3, F.lit(-5)).otherwise(F.col("idade")))
    root = fresh_dir(spark, "quarantine")
    built = build_warehouse(spark, bad, root=root, gate="quarantine")
    for got in (built, load_warehouse(spark, root)):
        assert [r.id_notificacao for r in got["_quarantine_fato_notificacoes"].collect()] == [3]
        assert got["fato_notificacoes"].filter("id_notificacao = 3").count() == 0
        for name in ("fato_notificacao_sintoma", "fato_notificacao_condicao", "fato_testes_realizados"):
            assert got[name].filter("fk_notificacao = 3").count() == 0
            assert (got[name].count() + got[f"_quarantine_{name}"].count() == wh[name].count())
        assert got["fato_notificacoes"].count() == wh["fato_notificacoes"].count() - 1


def test_id_keys_are_checked_bucket_by_bucket(spark, wh):
    from planutil import plan_text
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        child, parent = wh["fato_notificacao_sintoma"], wh["fato_notificacoes"]
        with_plan = Q.sized_broadcast
        Q.sized_broadcast = lambda df, *a, **k: df  # as for a parent beyond the bound
        plan = plan_text(Q.orphan_violations(child, "c", ["fk_notificacao"], "fk_notificacao", parent,
                                             "id_notificacao", "p"), "simple")
    finally:
        Q.sized_broadcast = with_plan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2


def _after(monkeypatch, name, change):
    """The build's step ``J.<name>`` with its rows changed."""
    from vigia.plans import etl
    made = getattr(etl.J, name)
    monkeypatch.setattr(etl.J, name, lambda *a, **k: change(made(*a, **k)))


BROKEN = {
    "null class": ("fact_notifications", lambda d: d.withColumn("classificacao_final", F.when(
        F.col("id_notificacao") != 4, F.col("classificacao_final"))), ("not_null", "fato_notificacoes", "4", "classificacao_final")),
    "double bridge key": ("bridge_symptoms", lambda d: d.unionByName(d.where("fk_notificacao = 2").limit(1)),
                          ("unique", "fato_notificacao_sintoma", "2|", "rows=2")),
    "unknown symptom": ("bridge_symptoms", lambda d: d.unionByName(d.where("fk_notificacao = 2").limit(1).withColumn(
        "fk_sintoma", F.lit(999).cast("smallint"))), ("foreign_key", "fato_notificacao_sintoma", "2|999", "fk_sintoma->dim_sintomas.id_sintoma")),
    "unknown notification": ("bridge_conditions", lambda d: d.unionByName(d.limit(1).withColumn(
        "fk_notificacao", F.lit(-1).cast("long"))), ("foreign_key", "fato_notificacao_condicao", "-1|",
                                                     "fk_notificacao->fato_notificacoes.id_notificacao")),
    "unknown place": ("fact_notifications", lambda d: d.withColumn("fk_localidade_residencia", F.when(
        F.col("id_notificacao") == 5, 77777).otherwise(F.col("fk_localidade_residencia"))),
        ("foreign_key", "fato_notificacoes", "5", "fk_localidade_residencia->dim_localidades.id_localidade"))}


@pytest.mark.parametrize("case", sorted(BROKEN))
def test_every_rule_stops_a_load(spark, wh, monkeypatch, case):
    from vigia.plans.etl import build_warehouse
    step, change, (rule, table, key, detail) = BROKEN[case]
    _after(monkeypatch, step, change)
    with pytest.raises(Q.IntegrityError):
        build_warehouse(spark, wh["clean"])
    found = build_warehouse(spark, wh["clean"], gate="report")["_violations"].collect()
    assert any(r.rule == rule and r.table_name == table and r.key.startswith(key) and r.detail == detail for r in found)
    assert {r.table_name for r in found} - {"indicadores_municipais"} == {table}  # the indicators follow the facts


def test_dimension_rules_stop_a_load_and_quarantine_moves_what_refers_to_them(spark, wh, monkeypatch):
    from vigia.plans import etl
    made = etl.D.dim_race
    twice = lambda c: made(c).withColumn("descricao_raca_cor", F.when(F.col("id_raca_cor") == 2, F.lit("x" * 60))
                                         .otherwise(F.col("descricao_raca_cor")))
    monkeypatch.setattr(etl.D, "dim_race", twice)
    with pytest.raises(Q.IntegrityError):
        etl.build_warehouse(spark, wh["clean"])
    got = etl.build_warehouse(spark, wh["clean"], gate="quarantine")
    assert [r.id_raca_cor for r in got["_quarantine_dim_raca_cor"].collect()] == [2]
    assert got["dim_raca_cor"].where("id_raca_cor = 2").count() == 0
    assert got["_quarantine_fato_notificacoes"].select("fk_raca_cor").distinct().collect() in ([], [(2,)])
    assert got["fato_notificacoes"].where("fk_raca_cor = 2").count() == 0
    ids = got["_quarantine_fato_notificacoes"].select("id_notificacao")
    for name in ("fato_notificacao_sintoma", "fato_testes_realizados"):
        assert got[name].join(ids, F.col("fk_notificacao") == F.col("id_notificacao"), "left_semi").count() == 0
        assert got[name].count() + got[f"_quarantine_{name}"].count() == wh[name].count()
    assert Q.warehouse_violations({n: got[n] for n in etl.DIMENSIONS + etl.FACTS}).count() == 0


def test_all_keys_of_a_table_are_counted_with_one_shuffle(spark):
    from planutil import plan_text
    df = spark.createDataFrame([(1, "a", 7), (1, "b", 7), (2, "b", None), (3, None, None), (None, None, 8), (None, "c", 8)],
                               "id long, name string, n int")
    keys = [["id"], ["name"], ["id", "n"], ["n"]]
    many = Q.unique_violations_many(df, "t", keys)
    apart = Q.union_all([Q.unique_violations(df, "t", k) for k in keys])
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, apart.collect())) and many.count() == 5
    assert plan_text(Q.unique_violations_many(df, "t", keys), "simple").count("Exchange") == 1


def test_gate_counts_keys_without_a_shuffle_of_the_facts(spark, wh):
    from planutil import plan_text
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    old = spark.conf.get(auto)
    spark.conf.set(auto, "false")
    try:
        for name in ("fato_notificacoes", "fato_notificacao_sintoma", "fato_testes_realizados"):
            assert "Exchange" not in plan_text(Q.unique_violations_many(wh[name], name, Q.UNIQUE[name]), "simple")
    finally:
        spark.conf.set(auto, old)


def test_quarantine_of_typed_keys(spark):
    df = spark.sql("select * from values (1, timestamp_ntz'2024-01-01 10:00:00.123456', 1.5d, date'2024-02-03', 'a'), "
                   "(1, timestamp_ntz'2024-01-01 10:00:00.123457', 1.5d, date'2024-02-03', 'b'), "
                   "(1, null, null, null, 'c'), (2, null, null, null, 'd') t(k, ts, x, d, name)")
    v = Q.check_violations(df, "t", ["k", "ts", "x", "d"], {"c": ~F.col("name").isin("a", "c")})
    good, bad = Q.quarantine(df, v, "t")
    assert sorted(r.name for r in bad.collect()) == ["a", "c"] and sorted(r.name for r in good.collect()) == ["b", "d"]
