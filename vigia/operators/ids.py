"""Dense, order-defined ids without a one-partition window (D8, S5 helpers).

``dense_index`` numbers the rows of a frame 1..n in a total order:

1. range-partition on the order key and sort inside each partition,
2. tag every row with its partition index and ``monotonically_increasing_id``
   and checkpoint (to the shared checkpoint folder) so the tags are frozen,
3. count rows per partition (one row per partition), prefix-sum those
   counts, broadcast them back (bounded by the partition count, not the data),
4. id = rows in earlier partitions + position inside the partition + 1.

Works for any size: the only single-task work is over one row per partition.
When the frame is *proven* small (a bounded row-count check, typical for a
dimension after de-duplication) a plain ``row_number`` over one ordered
partition is used instead: fewer jobs, same ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def packed_order(major: Column, minor: Column, minor_bits: int) -> Column:
    """``(major, minor)`` as one bigint that sorts the same way:
    ``major * 2^minor_bits + minor``.  A plain bigint keeps ``min``/``max``
    in hash aggregation (a struct key would force a sort-based aggregate that
    sorts the whole input).  Exact by construction: a value outside the
    packable range raises instead of wrapping."""
    ok = (major >= 0) & (major < 2 ** (63 - minor_bits)) & (minor >= 0) & (minor < 2 ** minor_bits)
    packed = F.shiftleft(major.cast("bigint"), minor_bits) + minor.cast("bigint")
    return F.when(ok, packed).otherwise(F.raise_error(F.lit("order key outside the packable range")))


_PART = "_vg_part"
_MONO = "_vg_mono"


def partition_offsets(counts: DataFrame, part_col: str, n_col: str = "_n", out: str = "_off") -> DataFrame:
    """Exclusive prefix sum of per-partition (or per-split) counts.  Input has
    one row per partition or file split, so the ordered window is tiny."""
    w = Window.orderBy(part_col).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(n_col).over(w), F.lit(0)).cast("bigint"))


# Row count up to which one ordered partition numbers a frame.
SMALL_ROWS = 100_000


def dense_index(df: DataFrame, order: list[Column | str], name: str, partitions: int | None = None,
                checkpoint: bool = True, small_rows: int = SMALL_ROWS) -> DataFrame:
    """Append ``name`` = 1..n following ``order`` (which must be total)."""
    from ..functions.joins import fits
    from ..session import shared_dir

    if checkpoint:
        shared_dir(df.sparkSession)
        # computed once: the size check and the numbering read the same rows
        df = df.checkpoint(eager=True)
    if small_rows and fits(df, small_rows):
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    spark = df.sparkSession
    n = partitions or max(1, spark.sparkContext.defaultParallelism)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = ranged.withColumns({_PART: F.spark_partition_id(), _MONO: F.monotonically_increasing_id()})
    # frozen tags: the counts and the final ids must see the same partitioning
    if checkpoint:
        tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    offsets = partition_offsets(counts, _PART).select(_PART, "_off")
    pos = F.col(_MONO) - F.shiftleft(F.col(_PART).cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), _PART)
            .withColumn(name, F.col("_off") + pos + 1)
            .drop(_PART, _MONO, "_off"))
