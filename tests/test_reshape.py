import datetime as dt


from planutil import plan_text
from vigia.operators import reshape as R


def test_explode_strips_unicode_space_and_keeps_empty_tokens(spark):
    df = spark.createDataFrame([(1, "Febre,  Tosse , Febre"), (2, "\tCoriza , "), (3, None)],
                               "id_notificacao long, sintomas string")
    got = sorted(tuple(r) for r in R.explode_multivalue(df, "sintomas", "v").collect())
    assert got == [(1, "Febre"), (1, "Tosse"), (2, ""), (2, "Coriza")]


def test_explode_keeps_first_position(spark):
    df = spark.createDataFrame([(1, "a, b, a")], "id_notificacao long, s string")
    got = {r.v: r.pos for r in R.explode_multivalue(df, "s", "v", keep_position=True).collect()}
    assert got == {"a": 0, "b": 1}


def _wide(spark):
    return spark.createDataFrame(
        [(1, 3, None, dt.date(2022, 1, 2), None, None, None), (2, None, None, None, None, 4, None)],
        "id_notificacao long, codigoEstadoTeste1 long, codigoTipoTeste1 long, dataColetaTeste1 date, "
        "codigoEstadoTeste2 long, codigoTipoTeste2 long, dataColetaTeste2 date")


def test_tests_long_keeps_slots_with_any_value(spark):
    out = R.tests_long(_wide(spark), slots=2)
    got = sorted((r.id_notificacao, r.test_number) for r in out.collect())
    assert got == [(1, 1), (2, 2)]
    # an absent metric (manufacturer) is not a column
    assert "codigoFabricanteTeste" not in out.columns


def test_tests_long_is_narrow(spark):
    assert "Exchange" not in plan_text(R.tests_long(_wide(spark), slots=2))


def test_unpivot_then_pivot_round_trip(spark):
    wide = _wide(spark)
    cols = R.wide_columns(wide, ["codigoEstadoTeste", "codigoTipoTeste", "dataColetaTeste"], 2)
    long = R.unpivot(wide, ["id_notificacao"], cols)
    assert long.count() == 3
    assert {r.metric_name for r in long.collect()} == {"codigoEstadoTeste", "dataColetaTeste", "codigoTipoTeste"}
    back = R.pivot_first(long, ["id_notificacao", "test_number"], "metric_name", "test_value", ["test_variable"],
                         ["codigoEstadoTeste", "codigoTipoTeste", "dataColetaTeste"])
    got = {(r.id_notificacao, r.test_number): (r.codigoEstadoTeste, r.dataColetaTeste) for r in back.collect()}
    assert got == {(1, 1): ("3", "2022-01-02"), (2, 2): (None, None)}


def test_pivot_first_uses_order(spark):
    long = spark.createDataFrame([(1, "m", "late", 2), (1, "m", "early", 1), (1, "m", None, 0)],
                                 "k long, metric string, value string, o long")
    row = R.pivot_first(long, ["k"], "metric", "value", ["o"], ["m"]).first()
    assert row.m == "early"


def test_variable_slot():
    assert R.variable_slot("codigoTipoTeste12") == ("codigoTipoTeste", 12)
