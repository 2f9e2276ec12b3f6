import datetime as dt

from pyspark.sql import functions as F

from vigia import labels
from vigia.operators import clean as C

SCHEMA = ("id_notificacao long, classificacaoFinal string, codigoResultadoTeste1 long, dataNotificacao date, "
          "dataInicioSintomas date, dataEncerramento date, idade double, sexo string, racaCor string, "
          "evolucaoCaso string, profissionalSaude string, profissionalSeguranca string")

D = dt.date


def _rows():
    return [
        (1, None, 1, D(2022, 3, 4), None, D(2022, 3, 1), 34.0, None, None, None, "Sim", None),
        (2, None, 2, D(2022, 3, 4), D(2022, 3, 6), D(2022, 3, 5), None, "F", "X", "Cura", "Não", "Ignorado"),
        (3, None, None, None, D(2022, 3, 6), None, 35.0, "M", "Y", None, None, "Sim"),
        (4, "Descartado", 1, D(2022, 3, 4), D(2022, 3, 2), None, None, None, None, None, "sim", "Não"),
    ]


def test_class_rules(spark):
    df = C.impute_class(spark.createDataFrame(_rows(), SCHEMA))
    got = dict(df.select("id_notificacao", "classificacaoFinal").collect())
    assert got == {1: labels.CONFIRMED, 2: labels.DISCARDED, 3: labels.SUSPECTED, 4: "Descartado"}


def test_class_rule_skipped_without_result_column(spark):
    df = spark.createDataFrame(_rows(), SCHEMA).drop("codigoResultadoTeste1")
    got = {r[0] for r in C.impute_class(df).select("classificacaoFinal").collect()}
    assert got == {labels.SUSPECTED, "Descartado"}


def test_onset_rules(spark):
    df = C.clamp_onset(C.impute_onset(spark.createDataFrame(_rows(), SCHEMA)))
    got = dict(df.select("id_notificacao", "dataInicioSintomas").collect())
    # 1: missing -> notification - 1; 2: after notification -> clamped; 3: no notification -> kept; 4: kept
    assert got == {1: D(2022, 3, 3), 2: D(2022, 3, 4), 3: D(2022, 3, 6), 4: D(2022, 3, 2)}


def test_onset_rule_on_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 3, 4, 10), None)],
                               "dataNotificacao timestamp, dataInicioSintomas timestamp")
    assert C.impute_onset(df).first()[1] == dt.datetime(2022, 3, 3, 10)


def test_closure_rule(spark):
    df = C.null_bad_closure(spark.createDataFrame(_rows(), SCHEMA))
    got = dict(df.select("id_notificacao", "dataEncerramento").collect())
    assert got == {1: None, 2: D(2022, 3, 5), 3: None, 4: None}


def test_median_is_exact_and_truncated(spark):
    df = C.impute_median(spark.createDataFrame(_rows(), SCHEMA))
    got = dict(df.select("id_notificacao", "idade").collect())
    # median(34, 35) = 34.5 -> 34 (truncation), taken over all rows incl. the one without date
    assert got == {1: 34, 2: 34, 3: 35, 4: 34}


def test_median_all_null_stays_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id_notificacao long, idade double")
    assert [r[0] for r in C.impute_median(df).select("idade").collect()] == [None, None]


def test_defaults_and_drop(spark):
    df = C.clean_notifications(spark.createDataFrame(_rows(), SCHEMA))
    assert sorted(r[0] for r in df.select("id_notificacao").collect()) == [1, 2, 4]
    row = df.filter("id_notificacao = 1").first()
    assert (row.sexo, row.racaCor, row.evolucaoCaso) == (labels.SEX_DEFAULT, labels.RACE_DEFAULT,
                                                         labels.OUTCOME_DEFAULT)


def test_bool_flags(spark):
    df = C.bool_flags(spark.createDataFrame(_rows(), SCHEMA))
    got = {r[0]: (r[1], r[2]) for r in df.select("id_notificacao", "profissionalSaude", "profissionalSeguranca").collect()}
    assert got == {1: (True, False), 2: (False, False), 3: (False, True), 4: (False, False)}
    assert df.filter(F.col("profissionalSaude").isNull()).count() == 0


def test_clean_invariant_onset_not_after_notification(wh):
    bad = wh["clean"].filter(F.col("dataInicioSintomas") > F.col("dataNotificacao")).count()
    assert bad == 0


def test_warehouse_row_counts_observed(wh):
    rows = wh.rows
    assert rows["raw"] == 1500 and rows["dropped_without_date"] == 4
    assert rows["clean"] == 1496 == wh["clean"].count()
    assert rows["fato_testes_realizados"] == wh["fato_testes_realizados"].count()


def test_one_pass_median_equals_scalar_median(spark, wh):
    from conftest import SMALL_SF
    from vigia.sources.fixture import raw_notifications
    raw = raw_notifications(spark, SMALL_SF)
    direct = raw.select(F.median(F.col("idade"))).first()[0]
    assert wh.median_age == direct
    a = sorted(map(tuple, C.clean_notifications(raw).select("id_notificacao", "idade").collect()))
    b = sorted(map(tuple, wh["clean"].select("id_notificacao", "idade").collect()))
    assert a == b
