from pyspark.sql import functions as F

from vigia.operators import dims as D
from vigia.operators.ids import dense_index, packed_order


def test_keep_first_keeps_null_names(spark):
    rows = spark.createDataFrame(
        [(None, None, "A", 1100001, 0, 5), ("S", "SS", "B", 1100001, 0, 7), ("T", "TT", "C", 1100001, 1, 1)],
        "estado_nome string, estado_uf string, municipio_nome string, codigo_ibge_municipio int, _src int, _row long")
    row = D.keep_first(rows, "codigo_ibge_municipio", ["_src", "_row"],
                       ["estado_nome", "estado_uf", "municipio_nome"]).first()
    assert (row.estado_nome, row.estado_uf, row.municipio_nome) == (None, None, "A")


def test_localities_prefer_residence_and_derive_state(spark):
    clean = spark.createDataFrame(
        [(1, "Pará", "PA", "Belém", 1501402, "Pará", "PA", "Belém (N)", 1501402),
         (2, "Pará", "PA", "Ananindeua", None, "São Paulo", "SP", "Campinas", 3509502)],
        "id_notificacao long, estado string, estadoIBGE string, municipio string, municipioIBGE long, "
        "estadoNotificacao string, estadoNotificacaoIBGE string, municipioNotificacao string, "
        "municipioNotificacaoIBGE long")
    got = {r.codigo_ibge_municipio: (r.id_localidade, r.municipio_nome, r.codigo_ibge_estado)
           for r in D.dim_localities(clean).collect()}
    # residence rows first, then notification-only places; state code = first two digits
    assert got == {1501402: (1, "Belém", 15), 3509502: (2, "Campinas", 35)}


def test_first_appearance_numbering(spark):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (2, "b"), (4, None), (5, "c")], "id_notificacao long, v string")
    got = {r.v: r.id for r in D.first_appearance_dim(df, "v", ["id_notificacao"], "id", "v").collect()}
    assert got == {"a": 1, "b": 2, "c": 3}


def test_dense_index_is_partition_independent(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    # distributed path (range partitions + offsets) and the proven-small path
    one = dense_index(df.repartition(1), ["k"], "rn", partitions=1, small_rows=0)
    many = dense_index(df.repartition(13), ["k"], "rn", partitions=8, small_rows=0)
    small = dense_index(df.repartition(13), ["k"], "rn")
    a = sorted(tuple(r) for r in one.collect())
    b = sorted(tuple(r) for r in many.collect())
    c = sorted(tuple(r) for r in small.collect())
    assert a == b == c
    assert [r.rn for r in many.orderBy("k").collect()] == list(range(1, 5001))


def test_dimension_ids_dense(wh):
    for name, col in [("dim_localidades", "id_localidade"), ("dim_sintomas", "id_sintoma"),
                      ("dim_condicoes", "id_condicao"), ("dim_raca_cor", "id_raca_cor"),
                      ("dim_evolucao_caso", "id_evolucao")]:
        ids = sorted(r[0] for r in wh[name].select(col).collect())
        assert ids == list(range(1, len(ids) + 1)), name


def test_no_notification_suffix_in_localities(wh):
    # every residence code is also a notification code: the residence name must win
    assert wh["dim_localidades"].filter(F.col("municipio_nome").endswith(" (N)")).count() == 0


def test_extend_dimension_keeps_known_ids(spark):
    prev = spark.createDataFrame([(1, "Febre"), (2, "Tosse")], "id_sintoma smallint, nome_sintoma string")
    vals = spark.createDataFrame([(5, 0, "Tosse"), (6, 1, "Cefaleia"), (4, 0, "Anosmia"), (7, 0, "Febre")],
                                 "id_notificacao long, pos int, nome_sintoma string")
    out = D.extend_dimension(prev, vals, "nome_sintoma", "id_sintoma", ["id_notificacao", "pos"])
    assert dict((r.nome_sintoma, r.id_sintoma) for r in out.collect()) == {
        "Febre": 1, "Tosse": 2, "Anosmia": 3, "Cefaleia": 4}
    assert out.schema["id_sintoma"].dataType.simpleString() == "smallint"


def test_keep_first_by_matches_struct_form(spark):
    rows = spark.createDataFrame(
        [(None, "A", 7, 0, 5), ("S", "B", 7, 0, 9), ("T", "C", 7, 1, 1), ("U", "D", 8, 1, 2), ("V", "E", 8, 1, 3)],
        "estado_nome string, municipio_nome string, code int, _src int, _row long")
    a = D.keep_first(rows, "code", ["_src", "_row"], ["estado_nome", "municipio_nome"])
    b = D.keep_first_by(rows, "code", packed_order(F.col("_src"), F.col("_row"), 62), ["estado_nome", "municipio_nome"])
    assert sorted((r.code, r.estado_nome, r.municipio_nome) for r in a.collect()) == \
        sorted((r.code, r.estado_nome, r.municipio_nome) for r in b.collect()) == [(7, None, "A"), (8, "U", "D")]


def test_packed_order_is_exact_or_fails(spark):
    import pytest
    ok = spark.createDataFrame([(1, 3), (1, 2), (0, 99)], "a long, b long")
    got = [r[0] for r in ok.orderBy(packed_order(F.col("a"), F.col("b"), 20)).select("b").collect()]
    assert got == [99, 2, 3]
    bad = spark.createDataFrame([(1, 1 << 21)], "a long, b long")
    with pytest.raises(Exception):
        bad.select(packed_order(F.col("a"), F.col("b"), 20)).collect()


def test_first_appearance_is_hash_aggregated(wh):
    from planutil import plan_text
    from vigia.operators.reshape import explode_multivalue
    ex = explode_multivalue(wh["clean"], "sintomas", "v", keep_position=True)
    plan = plan_text(ex.groupBy("v").agg(F.min(D.first_key(["id_notificacao", "pos"]))))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_dimension_ids_do_not_depend_on_partitioning(wh):
    clean = wh["clean"]
    layouts = [clean.repartition(1), clean.repartition(5, "sexo"), clean.repartition(11)]
    for build in (D.dim_localities, D.dim_symptoms, D.dim_conditions, D.dim_race, D.dim_outcome):
        results = [sorted(map(tuple, build(c).collect())) for c in layouts]
        assert results[0] == results[1] == results[2], build.__name__


def test_fact_with_notification_place(wh):
    from vigia.operators.facts import fact_notifications
    t = wh.tables
    fact = fact_notifications(t["clean"], t["dim_localidades"], t["dim_raca_cor"], t["dim_evolucao_caso"],
                              with_notification_place=True)
    assert fact.filter(F.col("fk_localidade_notificacao").isNull()).count() == 0
    assert fact.count() == t["fato_notificacoes"].count()


def test_narrow_id_raises_instead_of_wrapping(spark):
    import pytest
    ok = spark.createDataFrame([(5,)], "i long").select(D.narrow_id(F.col("i"), "smallint").alias("i"))
    assert ok.schema["i"].dataType.simpleString() == "smallint" and ok.first().i == 5
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            spark.createDataFrame([(40000,)], "i long").select(D.narrow_id(F.col("i"), "smallint")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
