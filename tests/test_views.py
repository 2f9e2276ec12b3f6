from pyspark.sql import functions as F

from planutil import plan_text
from vigia import labels
from vigia.plans import indicators as K
from vigia.plans import views as V


def test_vaccination_case_branches(spark):
    df = spark.createDataFrame([(2, "1,2"), (1, None), (1, ""), (3, "1,2,Reforço"), (1, "1"), (None, None)],
                               "r long, d string")
    got = [r[0] for r in df.select(V.vaccination_status(F.col("r"), F.col("d"))).collect()]
    assert got == [labels.VAX_NOT_VACCINATED, labels.VAX_NOT_INFORMED, labels.VAX_NOT_INFORMED,
                   labels.VAX_TWO_OR_MORE, labels.VAX_ONE_OR_OTHER, labels.VAX_NOT_INFORMED]


def test_age_bands(spark):
    ages = [9, 10, 19, 20, 39, 40, 59, 60, None, -1]
    df = spark.createDataFrame([(a,) for a in ages], "a int")
    got = [r[0] for r in df.select(V.age_band(F.col("a"))).collect()]
    assert got == ["0-9 anos", "10-19 anos", "10-19 anos", "20-39 anos", "20-39 anos", "40-59 anos",
                   "40-59 anos", "60+ anos", labels.AGE_UNKNOWN, "0-9 anos"]


def test_kpi_zero_confirmed(spark):
    empty = spark.createDataFrame([], "municipio_nome string, estado_uf string, total_casos long, "
                                      "casos_confirmados long, obitos long")
    t = {"__profile": empty}
    orig = V.epidemiological_profile
    try:
        V.epidemiological_profile = lambda _t: _t["__profile"]
        row = K.kpi_summary(t, with_text=True).first()
    finally:
        V.epidemiological_profile = orig
    assert (row.confirmados, row.letalidade, row.letalidade_txt) == (0, 0.0, "0.00%")


def test_invariants(wh):
    t = wh.tables
    v1 = V.cases_by_municipality(t).agg(F.sum("total_notificacoes")).first()[0]
    v4 = V.epidemiological_profile(t).agg(F.sum("total_casos")).first()[0]
    known = t["fato_notificacoes"].filter(F.col("fk_localidade_residencia").isNotNull()).count()
    assert v1 == v4 == known
    kpi = K.kpi_summary(t).first()
    assert K.confirmed_by_state(t).agg(F.sum("casos_confirmados")).first()[0] == kpi.confirmados
    pairs = t["fato_notificacao_sintoma"]
    assert pairs.count() == pairs.distinct().count()


def test_filter_reaches_below_aggregate(wh):
    q = K.confirmed_by_age(wh.tables, state="AM")
    plan = plan_text(q)
    # the state predicate is applied on the locality dimension scan
    assert "PushedFilters: [IsNotNull(estado_uf), EqualTo(estado_uf,AM)" in plan


def test_top_k_is_take_ordered(wh):
    assert "TakeOrderedAndProject" in plan_text(K.top_symptoms(wh.tables))


def test_no_python_in_views(wh):
    for fn in V.VIEWS.values():
        plan = plan_text(fn(wh.tables))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_top_laboratory_fallback(spark):
    empty = spark.createDataFrame([], "nome_laboratorio string, total_testes long")
    fallback = spark.createDataFrame([(labels.LAB_UNAVAILABLE, 0)], "nome_laboratorio string, total_testes long")
    assert tuple(K._top_or_default(empty, fallback).first()) == (labels.LAB_UNAVAILABLE, 0)


def test_big_joins_are_co_located(spark, wh):
    """With broadcasts off (as for large tables) the fact x bridge and
    fact x tests joins read both sides as bucketed scans (no exchange)."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for fn, child in [(V.frequent_symptoms, "fato_notificacao_sintoma"),
                          (V.laboratory_analysis, "fato_testes_realizados"),
                          (V.positivity_rate, "fato_testes_realizados")]:
            plan = plan_text(fn(wh.tables), "simple")
            scans = [ln for ln in plan.splitlines() if "FileScan" in ln and ("_fato_notificacoes[" in ln or
                                                                              f"_{child}[" in ln)]
            assert len(scans) == 2 and all("Bucketed: true" in ln for ln in scans), (fn.__name__, scans)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dashboard_views_are_released(wh):
    from vigia.plans.session_cache import dashboard_views
    with dashboard_views(wh.tables) as frames:
        assert set(frames) == set(V.VIEWS)
        assert all(df.is_cached for df in frames.values())
        total = frames["vw_perfil_epidemiologico"].agg(F.sum("total_casos")).first()[0]
    assert not any(df.is_cached for df in frames.values())
    assert total == K.kpi_summary(wh.tables).first().total_notificacoes


def test_indicators_read_the_kept_views(wh):
    from vigia.plans.session_cache import dashboard_views
    fns = (K.kpi_summary, K.confirmed_by_state, K.epidemic_curve, K.cases_by_sex, K.confirmed_by_age, K.vaccine_outcome,
           K.top_symptoms, K.top_municipalities, K.top_laboratories)
    want = [fn(wh.tables, state="AM").collect() for fn in fns]
    with dashboard_views(wh.tables) as frames:
        for fn, rows in zip(fns, want, strict=True):
            df = fn(wh.tables | frames, state="AM")
            assert "InMemoryTableScan" in plan_text(df, "simple") and df.collect() == rows, fn.__name__


def test_dimensions_are_broadcast_in_views(wh):
    """Dimension joins of the views are broadcast hash joins (no shuffle of the fact for them)."""
    for fn in (V.cases_by_municipality, V.vaccination_by_result, V.epidemiological_profile):
        plan = plan_text(fn(wh.tables), "simple")
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, fn.__name__


def test_top_k_ties_at_rank_k_break_by_name(spark):
    df = spark.createDataFrame([("d", 5), ("b", 3), ("a", 3), ("c", 3), ("e", 1)], "nome_sintoma string, n long")
    got = [tuple(r) for r in K._top(df, "nome_sintoma", "n", 3).collect()]
    assert got == [("d", 5), ("a", 3), ("b", 3)]
    again = [tuple(r) for r in K._top(df.repartition(3), "nome_sintoma", "n", 3).collect()]
    assert again == got
