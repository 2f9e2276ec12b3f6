import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from vigia.functions.dates import parse_day_first
from vigia.sources import csv as S
from vigia.sources.row_ids import with_file_row_id


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="vigia-csv-")
    p = os.path.join(d, "a.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_day_first_parsing(spark):
    df = spark.createDataFrame([("4/3/2022",), ("04/03/2022",), ("31/02/2022",), ("2022-03-04",), ("45000",),
                                (None,)], "s string")
    got = [r[0] for r in df.select(parse_day_first(F.col("s"))).collect()]
    ts = dt.datetime(2022, 3, 4)
    assert got == [ts, ts, None, ts, None, None]


def test_csv_quoted_comma_and_newline(spark):
    p = _write('a,b\n"x, y","line1\nline2"\n"say ""hi""",NA\n')
    df = S.read_csv(spark, p, multi_line=True)
    rows = [tuple(r) for r in df.collect()]
    assert rows == [("x, y", "line1\nline2"), ('say "hi"', "NA")]
    assert [tuple(r) for r in S.null_tokens(df).collect()][1] == ('say "hi"', None)


def test_read_notifications_types_and_drops(spark):
    p = _write("dataNotificacao,idade,excluido,sintomas\n4/3/2022,34,False,\"Febre, Tosse\"\n"
               "31/02/2022,abc,True,null\n")
    df = S.read_notifications(spark, p)
    assert "excluido" not in df.columns
    rows = sorted((r.id_notificacao, r.dataNotificacao, r.idade, r.sintomas) for r in df.collect())
    assert rows == [(1, dt.datetime(2022, 3, 4), 34.0, "Febre, Tosse"), (2, None, None, None)]


def test_dense_row_id_follows_file_order_across_splits(spark):
    d = tempfile.mkdtemp(prefix="vigia-ids-")
    n = 20000
    df = spark.range(n).select((F.col("id") + 1).alias("expected"), F.repeat(F.lit("x"), 50).alias("pad"))
    S.write_csv(df, d, order_by="expected", files=3)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        back = S.read_csv(spark, d)
        for hashed in (True, False):   # hashed split key, and the exact path-keyed fallback
            out = with_file_row_id(back, "row_id", hash_key=hashed)
            bad = out.filter(F.col("row_id") != F.col("expected").cast("long")).count()
            assert out.count() == n and bad == 0
        assert back.rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_active_only_filters_before_drop_and_after_ids(spark):
    p = _write("excluido,dataNotificacao\nFalse,1/1/2022\nTrue,2/1/2022\n,3/1/2022\n")
    every = S.read_notifications(spark, p)
    active = S.read_notifications(spark, p, active_only=True)
    assert "excluido" not in active.columns
    assert every.count() == 3
    # ids are file positions, assigned before the filter
    assert sorted(r.id_notificacao for r in active.collect()) == [1, 3]


def test_day_first_parsing_is_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # 18/10/1992: daylight saving started at local midnight that day
        df = spark.createDataFrame([("18/10/1992",), ("4/3/2022 10:5",), ("4/3/2022 25:00",)], "s string")
        got = [r[0] for r in df.select(parse_day_first(F.col("s"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(1992, 10, 18), dt.datetime(2022, 3, 4, 10, 5), None]


def test_iso_dates_and_times(spark):
    df = spark.createDataFrame([("2022-03-04T10:05:06.500Z",), ("2022-03-04 10:05",), ("2022-13-04",),
                                ("4/3/2022 1:2:3",)], "s string")
    got = [r[0] for r in df.select(parse_day_first(F.col("s"))).collect()]
    assert got == [dt.datetime(2022, 3, 4, 10, 5, 6, 500000), dt.datetime(2022, 3, 4, 10, 5), None,
                   dt.datetime(2022, 3, 4, 1, 2, 3)]
    own = [r[0] for r in df.select(parse_day_first(F.col("s"), ["yyyy-M-d"])).collect()]
    assert own[3] is None


def test_integral_decimals_are_read_and_failures_counted(spark):
    p = _write("dataNotificacao,municipioIBGE,codigoResultadoTeste1,idade\n4/3/2022,1501402.0,2.0,34\n"
               "2022-03-05,1501402,1.5,x\n6/3/2022,NA,1e0,\n")
    rows = [tuple(r) for r in S.read_notifications(spark, p, check=True).orderBy("id_notificacao").select(
        "municipioIBGE", "codigoResultadoTeste1", "idade").collect()]
    assert rows == [(1501402, 2, 34.0), (1501402, None, None), (None, 1, None)]
    failed = S.check_typing(S.null_tokens(S.read_csv(spark, p)))
    assert sorted(failed) == [("codigoResultadoTeste1", 3, 1), ("idade", 2, 1)]


def test_a_required_column_that_cant_be_typed_raises(spark):
    p = _write("dataNotificacao,municipioIBGE\nMarch 4th,1501402\n")
    with pytest.raises(S.TypingError):
        S.read_notifications(spark, p, check=True)


def test_the_file_position_can_replace_an_id_column(spark):
    p = _write("id_notificacao,dataNotificacao\n77,4/3/2022\n78,5/3/2022\n")
    assert [r[0] for r in S.read_notifications(spark, p).select("id_notificacao").collect()] == [77, 78]
    own = S.read_notifications(spark, p, keep_file_id=False)
    assert sorted(r[0] for r in own.select("id_notificacao").collect()) == [1, 2]


@pytest.mark.parametrize("before,after", [("65536", "262144"), ("262144", "65536")])
def test_changed_splits_give_right_ids_or_an_error(spark, before, after):
    d = tempfile.mkdtemp(prefix="vigia-ids-")
    n, key = 20000, "spark.sql.files.maxPartitionBytes"
    S.write_csv(spark.range(n).select((F.col("id") + 1).alias("expected"), F.repeat(F.lit("x"), 50).alias("pad")), d,
                order_by="expected", files=3)
    old = spark.conf.get(key)
    try:
        for freeze in (False, True):
            spark.conf.set(key, before)
            out = with_file_row_id(S.read_csv(spark, d), "row_id", freeze=freeze)
            spark.conf.set(key, after)
            try:
                rows = out.select("expected", "row_id").collect()
            except Exception as e:  # noqa: BLE001
                assert not freeze and "input splits changed" in str(e)
                continue
            assert len(rows) == n and all(int(r.expected) == r.row_id for r in rows)
    finally:
        spark.conf.set(key, old)


@pytest.mark.parametrize("before,after", [("65536", "262144"), ("262144", "65536"), ("6500", "5000"), ("5000", "6500")])
def test_changed_splits_behind_a_filter_or_a_limit(spark, before, after):
    """What a query shows of the ids is right, or it raises, however few rows it asks for."""
    d = tempfile.mkdtemp(prefix="vigia-ids-")
    n, key = 6000, "spark.sql.files.maxPartitionBytes"
    S.write_csv(spark.range(n).select((F.col("id") + 1).alias("expected"), F.repeat(F.lit("x"), 50).alias("pad"),
                                      (F.col("id") % 7 != 3).alias("excluido")), d, order_by="expected", files=3)
    wanted = [lambda o: o.where("expected = '126'"), lambda o: o.where("expected > '599' and pad is not null"),
              lambda o: o.limit(1), lambda o: o.limit(40), lambda o: o.where("expected like '%77'").limit(2),
              lambda o: S.active_rows(o).where("expected like '%9'")]
    old, raised = spark.conf.get(key), 0
    try:
        for ask in wanted:
            spark.conf.set(key, before)
            out = with_file_row_id(S.read_csv(spark, d), "row_id")
            same = ask(out).select("expected", "row_id").collect()
            assert same and all(int(r.expected) == r.row_id for r in same)
            spark.conf.set(key, after)
            try:
                rows = ask(out).select("expected", "row_id").collect()
            except Exception as e:  # noqa: BLE001
                assert "input splits changed" in str(e)
                raised += 1
                continue
            assert all(int(r.expected) == r.row_id for r in rows)
    finally:
        spark.conf.set(key, old)
    assert raised


def test_filters_stay_above_the_id_check(spark):
    from planutil import plan_text
    p = _write("excluido,dataNotificacao\nFalse,1/1/2022\nTrue,2/1/2022\n")
    plan = plan_text(S.read_notifications(spark, p, active_only=True).where("dataNotificacao is not null"), "simple")
    nodes = [line.strip(" +-:*()0123456789") for line in plan.splitlines()]
    check = next(i for i, line in enumerate(nodes) if "input splits changed" in line)
    assert any(line.startswith("Filter") for line in nodes[:check])
    assert not any(line.startswith("Filter") and "excluido" in line for line in nodes[check:])
    counted = plan_text(S.read_notifications(spark, p).groupBy("id_notificacao").count(), "simple")
    assert "Sort [_vg_mono" not in counted  # an aggregate takes all rows anyway
