import datetime as dt

from pyspark.sql import functions as F

from vigia.operators import audit as A


def test_snapshot_diff_null_to_value_is_an_update(spark):
    old = spark.createDataFrame([(1, None, "a"), (2, "x", "b"), (3, "y", "c")], "k long, v string, w string")
    new = spark.createDataFrame([(1, "now", "a"), (2, "x", "b"), (4, "z", "d")], "k long, v string, w string")
    got = {r.registro_id: r.operacao for r in A.snapshot_diff(old, new, "k", "t").collect()}
    assert got == {1: "UPDATE", 3: "DELETE", 4: "INSERT"}
    row = A.snapshot_diff(old, new, "k", "t").filter("registro_id = 1").first()
    assert row.dados_antigos == '{"k":1,"v":null,"w":"a"}'


def _events(spark, rows):
    return spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), u, t, p) for i, (m, u, t, p) in enumerate(rows)],
        "event_id long, ts timestamp, user_id long, event_type string, props string")


def test_change_log_state_machine(spark):
    ev = _events(spark, [
        (0, 1, "error", "{}"),      # delete of an absent key: nothing
        (1, 1, "view", "a"),        # insert
        (2, 1, "view", "a"),        # same image: nothing
        (90, 1, "click", "a"),      # update (next hour bucket)
        (200, 1, "error", "x"),     # delete
        (201, 1, "error", "x"),     # delete of absent: nothing
        (300, 1, "view", None),     # insert again
    ])
    log = A.change_log(ev, "user_id", ["ts", "event_id"], ["event_type", "props"], F.col("event_type") == "error",
                       "events", keep=["event_id"])
    got = [(r.event_id, r.operacao) for r in log.orderBy("event_id").collect()]
    assert got == [(1, "INSERT"), (3, "UPDATE"), (4, "DELETE"), (6, "INSERT")]
    upd = log.filter("event_id = 3").first()
    assert upd.dados_antigos == '{"event_type":"view","props":"a"}'


def test_bucketed_lag_equals_plain_lag(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 5000), rnd.choice([1, 2, 3]), rnd.choice(["view", "click", "error"]),
             rnd.choice(["a", "b", None])) for _ in range(400)]
    ev = _events(spark, rows)
    args = (ev, "user_id", ["ts", "event_id"], ["event_type", "props"], F.col("event_type") == "error", "events")
    fine = A.change_log(*args, keep=["event_id"], bucket=F.date_trunc("minute", F.col("ts")))
    whole = A.change_log(*args, keep=["event_id"], bucket=F.lit(0))
    assert sorted(map(tuple, fine.collect())) == sorted(map(tuple, whole.collect()))


def test_stream_matches_batch_when_slices_split_over_micro_batches(spark):
    from conftest import SMALL_SF
    from vigia.sources.tables import table
    from vigia.streaming.audit_stream import audit_stream

    ev = table(spark, SMALL_SF, "events")
    batch = A.change_log(ev, "user_id", ["ts", "event_id"], ["event_type", "props"],
                         F.col("event_type") == "error", "events", keep=["event_id"])
    # 3 slices x 4 key-disjoint files, 3 files per micro-batch: batches cut across slices
    stream = audit_stream(spark, ev, slices=3, files_per_slice=4, max_files_per_trigger=3)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_replay_old_plus_log_is_new(spark):
    from conftest import SMALL_SF
    from vigia.sources.tables import table
    o = table(spark, SMALL_SF, "orders")
    k = F.col("o_orderkey")
    old = o.filter(k % 10 != 3)
    new = o.filter(k % 10 != 4).withColumn("o_orderstatus", F.when(k % 10 == 5, F.lit("X")).otherwise(F.col("o_orderstatus")))
    log = A.snapshot_diff(old, new, "o_orderkey", "orders")
    assert sorted(map(tuple, A.replay(old, log, "o_orderkey").collect())) == sorted(map(tuple, new.collect()))


def test_stream_restart_neither_loses_nor_repeats(spark):
    """Stop after half the feed, restart on the same checkpoint with the rest:
    the log equals the batch log; a restart with no new input adds nothing."""
    from conftest import SMALL_SF
    from vigia.session import fresh_dir
    from vigia.sources.tables import table
    from vigia.streaming import audit_stream as S

    ev = table(spark, SMALL_SF, "events").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
                                                  "event_id", "event_type", "props")
    batch = A.change_log(ev, "user_id", ["ts", "event_id"], ["event_type", "props"],
                         F.col("event_type") == "error", "events", keep=["event_id"])
    cut = ev.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)).first()[0]
    early = ev.filter(F.unix_micros(F.col("ts").cast("timestamp")) <= cut)
    late = ev.filter(F.unix_micros(F.col("ts").cast("timestamp")) > cut)
    src, sink, ckpt = fresh_dir(spark, "t-src"), fresh_dir(spark, "t-sink"), fresh_dir(spark, "t-ckpt")
    S.stage_events(early, src, slices=2, files_per_slice=2)
    S.run_audit_stream(spark, src, sink, ckpt, max_files_per_trigger=2)
    first = S.read_log(spark, sink).count()
    S.stage_events(late, src, slices=2, files_per_slice=2)
    S.run_audit_stream(spark, src, sink, ckpt, max_files_per_trigger=2)
    S.run_audit_stream(spark, src, sink, ckpt, max_files_per_trigger=2)   # nothing new
    got = sorted(map(tuple, S.read_log(spark, sink).collect()))
    assert 0 < first < len(got)
    assert got == sorted(map(tuple, batch.collect()))


def test_fact_audit_between_loads_is_co_located(spark, wh):
    from planutil import plan_text
    from vigia.plans.etl import audit_fact_changes, build_warehouse

    # a second load where some notifications changed class and some are gone
    changed = wh["clean"].filter(F.col("id_notificacao") % 7 != 0).withColumn(
        "classificacaoFinal", F.when(F.col("id_notificacao") % 5 == 0, F.lit("Suspeito"))
        .otherwise(F.col("classificacaoFinal")))
    second = build_warehouse(spark, changed, buckets=wh.buckets, gate=False)
    log = audit_fact_changes(wh, second)
    ops = {r.operacao: r["count"] for r in log.groupBy("operacao").count().collect()}
    assert ops["DELETE"] == wh["fato_notificacoes"].filter(F.col("id_notificacao") % 7 == 0).count()
    assert "INSERT" not in ops and ops["UPDATE"] > 0
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(log, "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange hashpartitioning(id_notificacao" not in plan and plan.count("Bucketed: true") == 2


def test_a_hot_key_within_one_hour_is_split(spark):
    """A key with a third of all rows, in one hour: same log, several parts."""
    n = 3000
    ev = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("user_id"),
        F.timestamp_micros(F.col("id") * 1000).cast("timestamp_ntz").alias("ts"), F.col("id").alias("event_id"),
        F.when(F.col("id") % 15 == 0, "error").when(F.col("id") % 2 == 0, "click").otherwise("view").alias("event_type"),
        (F.col("id") % 4).cast("string").alias("props"))
    args = (ev, "user_id", ["ts", "event_id"], ["event_type", "props"], F.col("event_type") == "error", "events")
    hot, rows = A.hot_keys(ev, "user_id", 100)
    assert [tuple(r) for r in hot.collect()] == [(7, 1001)] and rows == 1001
    split = A.change_log(*args, keep=["event_id"], split_rows=100)
    whole = A.change_log(*args, keep=["event_id"])
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))
    assert A.hot_keys(ev, "user_id", n)[1] == 0


def test_a_hot_key_gives_equal_parts_and_no_cut_lists(spark):
    """One key holds a third of a million rows, its first half within one instant of the clock."""
    from planutil import plan_text
    n = 1_000_000
    ev = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("user_id"),
        F.timestamp_micros(F.greatest(F.col("id"), F.lit(n // 2))).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 15 == 0, "error").when(F.col("id") % 2 == 0, "click").otherwise("view").alias("event_type"),
        (F.col("id") % 4).cast("string").alias("props"))
    hot = ev.where("user_id = 7")
    sizes = [r["count"] for r in A.ranged_parts(hot, ["user_id", "ts", "event_id"], 34).groupBy("_part").count().collect()]
    assert len(sizes) == 34 and max(sizes) < 2 * n / 3 / 34
    args = (ev, "user_id", ["ts", "event_id"], ["event_type", "props"], F.col("event_type") == "error", "events")
    split = A.change_log(*args, keep=["event_id"], split_rows=10_000)
    assert "array" not in plan_text(split).lower().replace("arrayattribute", "") and "filter(" not in plan_text(split, "simple")
    digest = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38)"))).first())
    assert digest(split) == digest(A.change_log(*args, keep=["event_id"], split_rows=n))


def test_change_log_without_a_hot_key_reads_and_windows_the_feed_once(spark, tmp_path):
    from planutil import plan_text
    path = str(tmp_path / "feed")
    spark.range(100).selectExpr("id % 9 user_id", "timestamp_micros(id) ts", "id event_id", "'a' event_type",
                                "'b' props").write.parquet(path)
    plan = plan_text(A.change_log(spark.read.parquet(path), "user_id", ["ts", "event_id"], ["event_type", "props"],
                                  F.col("event_type") == "error", "events"), "simple")
    assert plan.count("FileScan") == 1 and plan.count("Window") == 1 and plan.count("Exchange") == 1


def _keyed_events(spark, rows, keys):
    return spark.range(rows).selectExpr(f"id % {keys} user_id", "cast(timestamp_micros(id) as timestamp_ntz) ts", "id event_id",
                                        "if(id % 7 = 0, 'error', 'click') event_type", "cast(id % 3 as string) props")


def test_a_repeated_batch_writes_the_same_rows_and_old_images_go(spark):
    from vigia.session import fresh_dir, list_names
    from vigia.streaming import audit_stream as S
    sink, state = fresh_dir(spark, "t-sink"), fresh_dir(spark, "t-state")
    ev = _keyed_events(spark, 60, 5)
    for i in range(6):
        part = ev.filter(f"event_id div 10 = {i}")
        for _ in range(2):  # as after a failure
            S.process_batch(part, i, S.EVENTS, sink, state, buckets=4)
    batch = A.change_log(ev, "user_id", ["ts", "event_id"], ["event_type", "props"],
                         F.col("event_type") == "error", "events", keep=["event_id"])
    assert sorted(map(tuple, S.read_log(spark, sink).collect())) == sorted(map(tuple, batch.collect()))
    assert list_names(spark, f"{state}/manifests") == ["0000000004.json", "0000000005.json"]
    now = S.images_before(spark, state, 6)
    images = spark.read.parquet(*now.paths(state, list(now.wrote)))
    last = ev.groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    assert images.count() == 5 and images.join(last, ["user_id", "event_id"]).count() == 5
    # folders of replaced images are gone, but for those a repeat of the last batch reads
    kept = [n for i in range(6) for n in list_names(spark, f"{state}/batch-{i:010d}") if n.startswith("_bucket")]
    assert len(kept) <= 2 * len(now.wrote)


def test_a_batch_reads_and_rewrites_the_buckets_of_its_keys_only(spark):
    from vigia.session import fresh_dir, list_names
    from vigia.streaming import audit_stream as S
    sink, state = fresh_dir(spark, "t-sink"), fresh_dir(spark, "t-state")
    first = _keyed_events(spark, 4000, 4000)
    S.process_batch(first, 0, S.EVENTS, sink, state, buckets=16)
    before = S.images_before(spark, state, 1)
    assert sorted(before.wrote) == list(range(16))
    one = _keyed_events(spark, 1, 1).selectExpr("5L user_id", "ts + interval 1 day ts", "9999L event_id", "'view' event_type", "props")
    bucket = one.select(F.pmod(F.xxhash64("user_id"), F.lit(16))).first()[0]
    # the images of all other buckets are out of reach: the batch can't have read them
    away = fresh_dir(spark, "t-away")
    import os
    plain = lambda p: p.replace("file:", "")
    os.makedirs(plain(away))
    for b in range(16):
        if b != bucket:
            os.rename(plain(f"{state}/batch-0000000000/_bucket={b}"), plain(f"{away}/{b}"))
    S.process_batch(one, 1, S.EVENTS, sink, state, buckets=99)  # the number of buckets is frozen
    after = S.images_before(spark, state, 2)
    assert after.buckets == 16 and {b for b, n in after.wrote.items() if n == 1} == {bucket}
    assert [n for n in list_names(spark, f"{state}/batch-0000000001") if n.startswith("_b")] == [f"_bucket={bucket}"]
    assert spark.read.parquet(*after.paths(state, [bucket])).where("user_id = 5").first().event_id == 9999
    log = S.read_log(spark, sink).where("registro_id = 5").orderBy("event_id").collect()
    assert [r.operacao for r in log] == ["INSERT", "UPDATE"]


def test_columns_new_to_the_second_snapshot_are_logged(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "id long, x string, y int")
    got = A.snapshot_diff(old, new, "id", "t").collect()
    assert [(r.operacao, r.registro_id, r.dados_novos) for r in got] == [("UPDATE", 2, '{"id":2,"x":"b","y":5}')]


def test_stored_log_goes_on_numbering(spark):
    from vigia.session import fresh_dir
    path = fresh_dir(spark, "log")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id long, x string")
    A.write_log(A.snapshot_diff(old, new, "id", "t"), path)
    log = A.write_log(A.snapshot_diff(new, old, "id", "t"), path).orderBy("id_log").collect()
    assert [r.id_log for r in log] == [1, 2, 3, 4, 5, 6] and [r.registro_id for r in log] == [1, 2, 3, 1, 2, 3]
    assert all(r.data_alteracao is not None and r.usuario_bd for r in log)


def test_the_first_join_of_a_diff_carries_digests_only(spark, tmp_path):
    from planutil import plan_text
    schema = "id long, a string, b double, c array<string>, d struct<x:int,y:string>, e map<string,int>"
    old = spark.createDataFrame([
        (1, None, 0.0, ["p", None], (1, None), {"k": 1}), (2, "x", 1.5, [], None, None), (3, "q", None, None, None, None),
        (4, "same", 2.0, ["a"], (2, "b"), {}), (None, "n", None, None, None, None), (6, None, 3.0, None, None, None)], schema)
    new = spark.createDataFrame([
        (1, None, -0.0, ["p", None], (1, None), {"k": 2}), (2, "x", 1.5, [None], None, None), (4, "same", 2.0, ["a"], (2, "b"), {}),
        (5, "in", None, None, None, None), (None, "m", None, None, None, None), (6, "3.0", None, None, None, None)], schema)
    strip = lambda df: sorted(map(str, df.collect()))
    for o, n in ((old.drop("e"), new.drop("e")), (old.drop("e"), old.drop("e")), (new.drop("e"), old.limit(0).drop("e"))):
        assert strip(A.snapshot_diff(o, n, "id", "t")) == strip(A.snapshot_diff(o, n, "id", "t", digests=False))
    got = {(r.registro_id, r.operacao) for r in A.snapshot_diff(old.drop("e"), new.drop("e"), "id", "t").collect()}
    assert got == {(2, "UPDATE"), (3, "DELETE"), (5, "INSERT"), (6, "UPDATE"), (None, "DELETE"), (None, "INSERT")}
    wide = spark.range(1000).selectExpr("id", "repeat('x', 500) pad", "id % 7 v")
    wide.write.parquet(str(tmp_path / "w"))
    old, new = spark.read.parquet(str(tmp_path / "w")), spark.read.parquet(str(tmp_path / "w")).where("id <> 3")
    plan = plan_text(A.snapshot_diff(old, new, "id", "t"), "simple")
    # the snapshots meet the few keys that differ where they are
    assert plan.count("BroadcastHashJoin") == 2


def test_a_repeated_append_adds_nothing(spark, monkeypatch):
    import pytest
    from vigia.session import fresh_dir
    path = fresh_dir(spark, "log")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id long, x string")
    first = A.snapshot_diff(old, new, "id", "t")
    for _ in range(2):
        assert A.write_log(first, path, batch="load 1/2").count() == 3
    # the rows are there, but the job ends before the manifest names them
    monkeypatch.setattr(A, "write_once", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        A.write_log(A.snapshot_diff(new, old, "id", "t"), path, batch="load 2/2")
    assert A.read_stored_log(spark, path).count() == 3
    monkeypatch.undo()
    for _ in range(2):
        log = A.write_log(A.snapshot_diff(new, old, "id", "t"), path, batch="load 2/2")
        assert sorted(r.id_log for r in log.collect()) == [1, 2, 3, 4, 5, 6]
    assert [(b.first, b.count, b.name) for b in A.log_batches(spark, path)] == [(1, 3, "load 1/2"), (4, 3, "load 2/2")]
    assert A.read_stored_log(spark, fresh_dir(spark, "no-log")).count() == 0


def test_the_stored_log_of_a_feed_keeps_its_sequence(spark):
    from vigia.session import fresh_dir
    ev = _events(spark, [(i, 1 + i % 2, "view", str(i)) for i in range(0, 40)])
    log = A.change_log(ev, "user_id", ["ts", "event_id"], ["event_type", "props"], F.col("event_type") == "error", "events")
    stored = A.write_log(log, fresh_dir(spark, "log"), sequence=["ts", "event_id"]).orderBy("id_log").collect()
    assert [r.dados_novos for r in stored] == ['{"event_type":"view","props":"%d"}' % i for i in range(40)]
    assert "ts" not in stored[0] and [r.id_log for r in stored] == list(range(1, 41))
