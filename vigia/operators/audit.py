"""Row-level change audit (A1-A5), re-aimed from a per-row database trigger.

Log row: ``(tabela_afetada, operacao, registro_id, dados_antigos, dados_novos)``
where the images are JSON objects of the whole row, NULL fields kept.

* ``snapshot_diff`` (A1-A3): two snapshots of a table, full outer join on the
  key.  INSERT = only new, DELETE = only old, UPDATE = both and the row is
  *distinct* (null-safe).  Keys meet with 128-bit digests of their rows first;
  whole rows are fetched, compared as structs and written as JSON images only
  for keys whose digests differ.
* ``change_log`` (A4): an ordered feed of row images per key (``seq``), where
  some events are deletes.  A key is present after any non-delete event and
  absent after a delete; an event on an absent key is an INSERT, a delete of
  an absent key changes nothing (no log row), an update is logged only when
  the image differs from the previous one.

``change_log`` needs each event's previous image in its key, a ``lag`` over
``partitionBy(key)``.  A hot key (say a third of all events) would be one task,
so the events of keys beyond a row count are dealt by ranges of (key, order)
instead: equal parts, whatever the key.  ``lag`` inside each part, and the first
row of a key in a part takes the key's last image of the part before, a prefix
scan over one row per (key, part).  Without a hot key the feed is shuffled once
and windowed once.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.joins import sized_broadcast
from ..session import list_names, write_once

JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss",
                "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
LOG_COLUMNS = ["tabela_afetada", "operacao", "registro_id", "dados_antigos", "dados_novos"]


def row_image(cols: list[str], prefix: str = "") -> Column:
    """JSON image of a row (all listed columns, NULLs written as null)."""
    return F.to_json(F.struct(*[F.col(prefix + c).alias(c) for c in cols]), JSON_OPTIONS)


def row_digest(columns: dict[str, Column], types: dict[str, str]) -> Column:
    """128 bits of a row: two 64-bit hashes of different seeds over its values
    and over which of them are null (a hash skips nulls).  Nested values count
    as their JSON text."""
    nested = ("array", "map", "struct", "variant")
    values = [F.to_json(F.struct(c.alias("v")), JSON_OPTIONS) if types[n].startswith(nested) else c
              for n, c in columns.items()]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns.values()])
    return F.struct(*[F.xxhash64(F.lit(seed), *values, nulls).alias(f"h{seed}") for seed in (1, 2)])


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, table: str, digests: bool = True) -> DataFrame:
    """A1-A3.  Columns of either snapshot count; one that a snapshot lacks is
    read as null there.

    The first join carries keys and digests only; the keys that differ are
    written once, and their rows fetched from both snapshots (without a shuffle
    of the snapshots where the keys are few enough to be sent to them).
    ``digests=False`` joins whole rows at once: for snapshots that are bucketed
    by the key, which meet without a shuffle."""
    from ..session import shared_dir

    cols = old.columns + [c for c in new.columns if c not in old.columns]
    types = dict(new.dtypes) | dict(old.dtypes)

    def values(df: DataFrame) -> dict[str, Column]:
        return {c: F.col(c) if c in df.columns else F.lit(None).cast(types[c]) for c in cols}

    def keyed(df: DataFrame, name: str, made) -> DataFrame:
        return df.select(F.col(key).alias("_k"), made(values(df)).alias(name))

    def compared(o: DataFrame, n: DataFrame, on: list[str]) -> DataFrame:
        j = o.join(n, on, "full_outer")
        op = (F.when(F.col("_old").isNull(), F.lit("INSERT")).when(F.col("_new").isNull(), F.lit("DELETE"))
              .when(~F.col("_old").eqNullSafe(F.col("_new")), F.lit("UPDATE")))
        return j.withColumn("operacao", op).filter(F.col("operacao").isNotNull())

    def whole(v: dict[str, Column]) -> Column:
        return F.struct(*[c.alias(n) for n, c in v.items()])

    o, n = keyed(old, "_old", whole), keyed(new, "_new", whole)
    if digests:
        shared_dir(old.sparkSession)
        hashed = lambda v: row_digest(v, types)
        differ = compared(keyed(old, "_old", hashed), keyed(new, "_new", hashed), ["_k"])
        differ = differ.select(F.col("_k").alias("_dk"), F.col("operacao").alias("_op")).distinct().checkpoint(eager=True)
        asked = sized_broadcast(differ)
        fetch = lambda rows, without: rows.join(
            asked.filter(F.col("_op") != without), F.col("_k").eqNullSafe(F.col("_dk"))).drop("_dk")
        changed = compared(fetch(o, "INSERT"), fetch(n, "DELETE"), ["_k", "_op"])
    else:
        changed = compared(o, n, ["_k"])
    return changed.select(
        F.lit(table).alias("tabela_afetada"), "operacao", F.col("_k").alias("registro_id"),
        F.when(F.col("operacao") != "INSERT", F.to_json("_old", JSON_OPTIONS)).alias("dados_antigos"),
        F.when(F.col("operacao") != "DELETE", F.to_json("_new", JSON_OPTIONS)).alias("dados_novos"))


def previous_in_key(df: DataFrame, key: str, order: list[str], carry: list[str], bucket: Column) -> DataFrame:
    """Add ``prev_<c>`` for each ``c`` in ``carry``: the value of the previous
    row of the same key in ``order`` (NULL for the key's first row), computed
    per (key, bucket) so no task holds more than one bucket of one key.
    ``bucket`` must be monotone in ``order``."""
    b = df.withColumn("_b", bucket)
    w = Window.partitionBy(key, "_b").orderBy(*order)
    inner = (b.withColumns({f"_lag_{c}": F.lag(c).over(w) for c in carry})
             .withColumn("_rn", F.row_number().over(w)))
    # the last row of every (key, bucket): a partial aggregate, one row per group and task in its shuffle
    last = b.groupBy(key, "_b").agg(F.max_by(F.struct(*carry), F.struct(*order)).alias("_last"))
    prev_bucket = (last.withColumn("_prev", F.lag("_last").over(Window.partitionBy(key).orderBy("_b")))
                   .select(F.col(key).alias("_pk"), F.col("_b").alias("_pb"), "_prev"))
    j = inner.join(prev_bucket, F.col(key).eqNullSafe(F.col("_pk")) & (F.col("_b") == F.col("_pb")), "left")
    return j.withColumns({
        f"prev_{c}": F.when(F.col("_rn") == 1, F.col(f"_prev.{c}")).otherwise(F.col(f"_lag_{c}")) for c in carry
    }).drop("_b", "_rn", "_prev", "_pk", "_pb", *[f"_lag_{c}" for c in carry])


def classify_changes(df: DataFrame, image_cols: list[str], is_delete: Column) -> DataFrame:
    """Given ``prev_<c>`` columns, decide the logged operation (or NULL)."""
    # the previous event's delete flag is NULL only when there is no previous event
    present = F.col("_prev_delete").isNotNull() & ~F.col("_prev_delete")
    same = F.lit(True)
    for c in image_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"prev_{c}"))
    op = (F.when(is_delete, F.when(present, F.lit("DELETE")))
          .when(~present, F.lit("INSERT"))
          .when(~same, F.lit("UPDATE")))
    return df.withColumn("operacao", op)


# Rows of a key beyond which its history is split.
SPLIT_ROWS = 100_000


def hot_keys(events: DataFrame, key: str, rows: int = SPLIT_ROWS) -> tuple[DataFrame, int]:
    """(key, rows) of the keys with more than ``rows`` rows, and the rows they
    hold together.  At most one key per ``rows`` rows is here."""
    from ..session import shared_dir

    shared_dir(events.sparkSession)
    hot = (events.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows)
           .checkpoint(eager=True))
    return hot, int(hot.agg(F.sum("_n")).first()[0] or 0)


def ranged_parts(rows: DataFrame, order: list[str], parts: int, name: str = "_part") -> DataFrame:
    """``rows`` dealt by ranges of ``order`` to about equal ``parts``, with the
    number of the part, which rises with ``order``.  Written once (checkpoint):
    the numbers are those of this deal, however often they are read."""
    from ..session import shared_dir

    shared_dir(rows.sparkSession)
    return rows.repartitionByRange(parts, *order).withColumn(name, F.spark_partition_id()).checkpoint(eager=True)


def change_log(events: DataFrame, key: str, order: list[str], image_cols: list[str], is_delete: Column,
               table: str, keep: list[str] | None = None, bucket: Column | None = None,
               split_rows: int = SPLIT_ROWS) -> DataFrame:
    """A4: the audit log of an ordered change feed (see module doc).

    Keys of up to ``split_rows`` rows are one window group each, in a single
    pass.  The history of larger keys is dealt by ranges to parts of about
    ``split_rows`` rows, and the first row of a part is seeded from the last row
    of the key's part before.  ``bucket`` splits every key by a column of your
    own instead; it must not fall where ``order`` rises."""
    feed = events.select(key, *order, *[c for c in image_cols if c not in order],
                         F.coalesce(is_delete, F.lit(False)).alias("_del"))
    carry = image_cols + ["_del"]

    def in_one_window(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(key).orderBy(*order)
        return rows.withColumns({f"prev_{c}": F.lag(c).over(w) for c in carry})

    if bucket is not None:
        with_prev = previous_in_key(feed, key, order, carry, bucket)
    else:
        hot, hot_rows = hot_keys(feed, key, split_rows)
        if not hot_rows:
            with_prev = in_one_window(feed)
        else:
            named = sized_broadcast(hot.select(F.col(key).alias("_hot")))
            is_hot = F.col(key).eqNullSafe(F.col("_hot"))
            dealt = ranged_parts(feed.join(named, is_hot, "left_semi"), [key, *order], -(-hot_rows // split_rows))
            split = previous_in_key(dealt, key, order, carry, F.col("_part")).drop("_part")
            with_prev = in_one_window(feed.join(named, is_hot, "left_anti")).unionByName(split)
    with_prev = with_prev.withColumnRenamed("prev__del", "_prev_delete")
    logged = classify_changes(with_prev, image_cols, F.col("_del")).filter(F.col("operacao").isNotNull())
    return logged.select(
        F.lit(table).alias("tabela_afetada"), "operacao", F.col(key).alias("registro_id"),
        *[F.col(c) for c in (keep if keep is not None else order)],
        F.when(F.col("operacao") != "INSERT", row_image(image_cols, "prev_")).alias("dados_antigos"),
        F.when(F.col("operacao") != "DELETE", row_image(image_cols)).alias("dados_novos"))


def with_log_defaults(log: DataFrame) -> DataFrame:
    """A5: change time and database user columns, filled at the sink."""
    return log.withColumns({"data_alteracao": F.current_timestamp(), "usuario_bd": F.current_user()})


@dataclass(frozen=True)
class LogBatch:
    """An entry of a stored log's manifest, which is its file name."""

    number: int
    first: int
    count: int
    name: str

    def file(self) -> str:
        return f"{self.number:010d}.{self.first}.{self.count}.{quote(self.name, safe='')}.json"

    @staticmethod
    def of(file: str) -> LogBatch:
        number, first, count, name = file.removesuffix(".json").split(".", 3)
        return LogBatch(int(number), int(first), int(count), unquote(name))

    def folder(self, path: str) -> str:
        return f"{path}/rows-{quote(self.name, safe='')}"


def log_batches(spark: SparkSession, path: str) -> list[LogBatch]:
    """The batches of a stored log, in order of their ids."""
    return [LogBatch.of(n) for n in list_names(spark, f"{path}/manifest") if n.endswith(".json")]


LOG_SCHEMA = ("id_log long, tabela_afetada string, operacao string, registro_id long, dados_antigos string, "
              "dados_novos string, data_alteracao timestamp, usuario_bd string")


def read_stored_log(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches in the manifest; those of an append that failed
    are not among them."""
    folders = [b.folder(path) for b in log_batches(spark, path)]
    if not folders:
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.parquet(*folders)


def write_log(changes: DataFrame, path: str, batch: str | None = None, sequence: list[str] | None = None) -> DataFrame:
    """A5: append changes to the stored audit log and return the whole log.

    ``id_log`` goes on from the stored rows, in the order of ``sequence``
    (columns of a change feed that ``change_log`` kept, say time and event),
    then of table, record, operation and images; change time and database user are filled here.

    ``batch`` names the append: one that is in the log already adds nothing, so
    a job may be repeated.  An append writes its rows to a folder of its own
    first, over what a failed attempt left there, and counts once its entry
    (first id and number of rows) is in the manifest.  Two jobs that append at
    once take the same entry: the second one raises and can be repeated."""
    from .ids import dense_index

    spark, path = changes.sparkSession, path.rstrip("/")
    known = log_batches(spark, path)
    if batch is not None and any(b.name == batch for b in known):
        return read_stored_log(spark, path)
    seen = known[-1].first + known[-1].count - 1 if known else 0
    columns = [*(sequence or []), *[c for c in LOG_COLUMNS if c not in (sequence or [])]]
    numbered = dense_index(changes.select(*columns),
                           [*(sequence or []), "tabela_afetada", "registro_id", "operacao", "dados_antigos", "dados_novos"],
                           "id_log")
    rows = numbered.withColumn("id_log", F.col("id_log") + F.lit(seen)).select("id_log", *LOG_COLUMNS)
    added = LogBatch(len(known), seen + 1, 0, batch or uuid.uuid4().hex)
    with_log_defaults(rows).write.mode("overwrite").parquet(added.folder(path))
    added = replace(added, count=spark.read.parquet(added.folder(path)).count())
    taken = [b for b in log_batches(spark, path) if b.number >= added.number]
    if taken:
        raise FileExistsError(f"another append to {path} came first: {taken[0].name}")
    write_once(spark, f"{path}/manifest/{added.file()}", json.dumps(asdict(added)))
    return read_stored_log(spark, path)


def replay(old: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Apply a snapshot-diff log to the old snapshot: the rows of the new one.
    Deleted and updated keys leave, inserted and updated images (parsed back
    from their JSON with the snapshot's schema) come in.  One anti-join and
    one union; the images keep every column, NULLs included."""
    changed = log.select(F.col("registro_id").alias("_k")).distinct()
    kept = old.join(changed, F.col(key) == F.col("_k"), "left_anti")
    images = (log.filter(F.col("dados_novos").isNotNull())
              .select(F.from_json("dados_novos", old.schema, JSON_OPTIONS).alias("_r")).select("_r.*"))
    return kept.unionByName(images)
