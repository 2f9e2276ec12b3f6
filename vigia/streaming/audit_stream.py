"""The change audit as a Structured Streaming job, for any keyed feed.

Every micro-batch (``foreachBatch``) runs the batch operator ``change_log``
over its events and the latest stored image of the keys it touches, all on the
JVM.  Which columns make the image, the key, the order and what counts as a
delete are parameters (:class:`Feed`).

* Log: one folder per batch id, overwritten if the batch is run again.
* Latest images: in hash buckets by key.  A batch reads only the buckets its
  keys fall into and writes new versions of them into a folder of its own; a
  manifest per batch id then names the version of every bucket.  A batch starts
  from the newest manifest before its own, so a repeated batch sees what it saw
  before.  Versions that neither the last manifest nor the one before names are
  deleted.

A batch that is repeated after a failure therefore writes the same rows to the
same place: no row is lost, none is written twice.  A live feed must deliver
each key's changes in order across micro-batches (e.g. a log partitioned by
key); ``stage_events`` produces such a feed from a table.  A key's burst within
a batch is split as in ``change_log``.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.audit import SPLIT_ROWS, change_log
from ..session import delete_path, fresh_dir, list_names, write_once

# Buckets of the latest-image table, frozen when its first batch is written:
# enough that one bucket's images fit into a task.
BUCKETS = 16


@dataclass(frozen=True)
class Feed:
    """A change feed: DDL of its columns, the key, the order within a key (its
    first column a timestamp), the image columns and a SQL delete rule."""

    schema: str
    key: str
    order: list[str]
    image: list[str]
    delete: str
    table: str
    keep: list[str] = field(default_factory=list)

    def columns(self) -> list[str]:
        return StructType.fromDDL(self.schema).names


EVENTS = Feed("user_id long, ts timestamp_ntz, event_id long, event_type string, props string", "user_id",
              ["ts", "event_id"], ["event_type", "props"], "event_type = 'error'", "events", ["event_id"])


def stage_events(events: DataFrame, path: str, slices: int = 4, key: str = "user_id",
                 files_per_slice: int | None = None, time: str = "ts") -> int:
    """Write the feed as ``slices`` time-ordered parts, one write each, so a
    file stream replays the parts in time order.

    The slice of a row comes from one monotone expression of its timestamp,
    computed in Spark for the bounds and the rows alike.  Inside a slice the
    files are hash-partitioned by key, so two files of a slice never share a
    key: however the stream groups files into micro-batches, every key sees
    its events in time order (the state machine needs nothing more).
    Returns the number of files per slice."""
    n = files_per_slice or events.sparkSession.sparkContext.defaultParallelism
    t = F.unix_micros(F.col(time).cast("timestamp"))
    lo, hi = events.agg(F.min(t), F.max(t)).first()
    if lo is None:
        events.write.mode("append").parquet(path)
        return n
    width = max(1, hi - lo + 1)
    idx = F.least(F.floor((t - F.lit(lo)) * F.lit(slices) / F.lit(width)).cast("int"), F.lit(slices - 1))
    tagged = events.withColumn("_slice", idx).persist()  # one pass over the source, whatever the slices
    try:
        for i in range(slices):
            (tagged.filter(F.col("_slice") == i).drop("_slice")
             .repartition(n, key).write.mode("append").parquet(path))
    finally:
        tagged.unpersist()
    return n


@dataclass(frozen=True)
class Images:
    """A version of the latest images: the batch that left it, the number of
    buckets, the batch that wrote the current rows of each bucket, and the
    version before: its batch and what this one replaced of it."""

    batch: int
    buckets: int
    wrote: dict[int, int] = field(default_factory=dict)
    before: int = -1
    replaced: dict[int, int] = field(default_factory=dict)

    def paths(self, state: str, touched: list[int]) -> list[str]:
        return [f"{state}/batch-{self.wrote[b]:010d}/_bucket={b}" for b in touched if b in self.wrote]

    def after(self, batch: int, touched: list[int]) -> Images:
        return Images(batch, self.buckets, self.wrote | dict.fromkeys(touched, batch), self.batch,
                      {b: self.wrote[b] for b in touched if b in self.wrote})


def _manifest(state: str, batch_id: int) -> str:
    return f"{state}/manifests/{batch_id:010d}.json"


def images_before(spark: SparkSession, state: str, batch_id: int, buckets: int = BUCKETS) -> Images:
    """The newest version that a batch before ``batch_id`` left."""
    known = [int(n[:-5]) for n in list_names(spark, f"{state}/manifests") if n.endswith(".json")]
    known = [n for n in known if n < batch_id]
    if not known:
        return Images(-1, buckets)
    meta = json.loads(spark.read.text(_manifest(state, max(known)), wholetext=True).first()[0])
    of = lambda name: {int(k): v for k, v in meta[name].items()}
    return Images(meta["batch"], meta["buckets"], of("wrote"), meta["before"], of("replaced"))


def publish(spark: SparkSession, state: str, images: Images, before: Images) -> None:
    """Make ``images`` the version of its batch.  The one before stays for a
    repeat of this batch; what that one had replaced goes (as many folders as
    its batch touched)."""
    delete_path(spark, _manifest(state, images.batch))  # of a run that failed after this point
    write_once(spark, _manifest(state, images.batch), json.dumps(asdict(images)))
    for bucket, batch in before.replaced.items():
        delete_path(spark, f"{state}/batch-{batch:010d}/_bucket={bucket}")
    if before.before >= 0:
        delete_path(spark, _manifest(state, before.before))


def _latest(rows: DataFrame, feed: Feed, order: list[str]) -> DataFrame:
    """The last row of every key."""
    columns = [c for c in feed.columns() if c != feed.key]
    return (rows.groupBy(feed.key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
            .select(feed.key, "_last.*"))


def process_batch(batch: DataFrame, batch_id: int, feed: Feed, sink: str, state: str,
                  split_rows: int = SPLIT_ROWS, buckets: int = BUCKETS) -> None:
    """One micro-batch: log rows to ``sink``, latest images to ``state``."""
    spark = batch.sparkSession
    columns = feed.columns()
    before = images_before(spark, state, batch_id, buckets)
    bucket = F.pmod(F.xxhash64(feed.key), F.lit(before.buckets)).cast("int")
    batch = batch.select(*columns).persist()  # read by the log and by the latest images
    try:
        touched = sorted(r[0] for r in batch.select(bucket.alias("b")).distinct().collect())  # bucket numbers
        live = batch.withColumn("_live", F.lit(1))
        paths = before.paths(state, touched)
        stored = None
        if paths:
            stored = spark.read.schema(feed.schema).parquet(*paths).select(*columns)
            seeds = stored.join(batch.select(feed.key).distinct(), feed.key, "left_semi")
            live = live.unionByName(seeds.select(*columns, F.lit(0).alias("_live")))
        log = change_log(live, feed.key, ["_live", *feed.order], feed.image, F.expr(feed.delete), feed.table,
                         keep=["_live", *feed.keep], split_rows=split_rows)
        # a seed is there to be the row before; what it was itself is logged already
        log.filter("_live = 1").drop("_live").write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        if touched:
            rows = batch.withColumn("_live", F.lit(1))
            if stored is not None:
                rows = rows.unionByName(stored.withColumn("_live", F.lit(0)))
            (_latest(rows, feed, ["_live", *feed.order]).withColumn("_bucket", bucket)
             .repartition(len(touched), "_bucket").write.mode("overwrite").partitionBy("_bucket")
             .parquet(f"{state}/batch-{batch_id:010d}"))
    finally:
        batch.unpersist()
    publish(spark, state, before.after(batch_id, touched), before)


def run_audit_stream(spark: SparkSession, src: str, sink: str, checkpoint: str, max_files_per_trigger: int = 1,
                     feed: Feed = EVENTS, split_rows: int = SPLIT_ROWS, buckets: int = BUCKETS) -> None:
    """Process every file under ``src`` not yet processed by the query whose
    checkpoint is ``checkpoint`` (``availableNow``).  Restarting with the same
    checkpoint continues where the last run stopped."""
    state = f"{checkpoint.rstrip('/')}-images"

    def each(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, feed, sink, state, split_rows, buckets)

    (spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(src)
     .writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def read_log(spark: SparkSession, sink: str, feed: Feed = EVENTS) -> DataFrame:
    """The log rows of a sink."""
    kinds = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(feed.schema)}
    ddl = ", ".join(["tabela_afetada string", "operacao string", f"registro_id {kinds[feed.key]}",
                     *[f"{c} {kinds[c]}" for c in feed.keep], "dados_antigos string", "dados_novos string"])
    log = spark.read.schema(ddl).parquet(sink)
    return log.select("tabela_afetada", "operacao", "registro_id", *feed.keep, "dados_antigos", "dados_novos")


def audit_stream(spark: SparkSession, events: DataFrame, slices: int = 4, files_per_slice: int | None = None,
                 max_files_per_trigger: int | None = None, feed: Feed = EVENTS, buckets: int = BUCKETS) -> DataFrame:
    """Drive the stream over a staged copy of ``events`` to completion
    (``availableNow``) and return the log it wrote."""
    src, sink, ckpt = fresh_dir(spark, "audit-src"), fresh_dir(spark, "audit-sink"), fresh_dir(spark, "audit-ckpt")
    rows = events.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(feed.schema)])
    per_slice = stage_events(rows, src, slices, feed.key, files_per_slice, feed.order[0])
    run_audit_stream(spark, src, sink, ckpt, max_files_per_trigger or per_slice, feed, buckets=buckets)
    return read_log(spark, sink, feed)
