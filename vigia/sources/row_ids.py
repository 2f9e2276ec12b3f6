"""Dense row id = position in the input files + 1, assigned before any filter.

``monotonically_increasing_id`` alone is not file order (splits are packed
into partitions largest first).  Instead:

1. tag each row with its split (``_metadata.file_path``,
   ``_metadata.file_block_start``) and ``monotonically_increasing_id``;
2. per split: row count and smallest tag (one row per split);
3. prefix-sum the counts in (path, block start) order: the split's offset;
4. id = offset + (tag - smallest tag of the split) + 1.

Rows of one split are contiguous inside a partition, in file order, so the
tag difference is the row's position in its split, if both passes cut and deal
the files alike.  They need not: split sizes follow settings and the number of
cores, which can change between the passes.  So every row is checked: its split
(path, start and length) must be one of the first pass, and its position must
lie within that split's row count.  A split dealt to another place shifts all its
positions by the same number, and then its first or its last row lies outside.

The proof needs all rows of a split, so nothing may thin them out before the
check, and no row may leave a task before the last one of its split was looked at:

* the projection that checks is marked as depending on the task, so no filter
  or limit is moved below it;
* a sort within the partition (by the tag: the rows are in order already) takes
  all rows of the task before it gives the first, so a limit can't stop short of
  the check.  Under an aggregate or a shuffle, which take all rows anyway, the
  planner leaves the sort out.

So every id that a query shows is right, or the query raises.  ``freeze`` writes the tagged rows to the shared folder first and
reads both passes from there: it never raises, for one more write of the rows.

The per-split table (one row per split, i.e. input bytes / split size, keyed
by a 64-bit path hash and the block start) is checkpointed once and broadcast
only after a size check (the plan changes with it, the ids don't).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import sized_broadcast
from ..session import shared_dir
from ..operators.ids import partition_offsets


def with_file_row_id(df: DataFrame, name: str = "row_id", max_splits_broadcast: int = 1_000_000,
                     hash_key: bool = True, freeze: bool = False) -> DataFrame:
    shared_dir(df.sparkSession)  # the checkpoint folder: read from the session, set only if unset
    tagged = df.withColumns({
        "_vg_file": F.col("_metadata.file_path"),
        "_vg_block": F.col("_metadata.file_block_start"),
        "_vg_len": F.col("_metadata.file_block_length"),
        "_vg_mono": F.monotonically_increasing_id(),
    })
    if freeze:
        tagged = tagged.checkpoint(eager=True)
    splits = (tagged.groupBy("_vg_file", "_vg_block")
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_vg_mono").alias("_vg_first"), F.min("_vg_len").alias("_len"))
              .withColumn("_vg_split", F.struct("_vg_file", "_vg_block")))
    offsets = (partition_offsets(splits, "_vg_split")
               .select(F.xxhash64("_vg_file").alias("_vg_fh"), "_vg_file", "_vg_block", "_vg_first", "_len", "_n", "_off")
               .checkpoint(eager=True))
    # The broadcast side is keyed by (64-bit hash of the path, block start):
    # about 40 bytes per split instead of the path text.  Exact or nothing: if
    # two paths share a hash, join on the path itself.
    collide = (not hash_key or
               offsets.groupBy("_vg_fh", "_vg_block").count().filter(F.col("count") > 1).limit(1).count() > 0)
    if collide:
        keys, side = ["_vg_file", "_vg_block"], offsets.drop("_vg_fh")
    else:
        keys, side = ["_vg_fh", "_vg_block"], offsets.drop("_vg_file")
        tagged = tagged.withColumn("_vg_fh", F.xxhash64("_vg_file"))
    place = F.col("_vg_mono") - F.col("_vg_first")
    # no comparison with a null (unknown split) is true; the partition id keeps filters above this projection
    same = (F.col("_vg_len") == F.col("_len")) & (place >= 0) & (place < F.col("_n")) & (F.spark_partition_id() >= 0)
    sure = F.when(same, F.col("_off") + place + 1).otherwise(F.raise_error(F.lit(
        "input splits changed between the two passes over the files: row ids would be wrong; read again, or freeze")))
    return (tagged.join(sized_broadcast(side, max_splits_broadcast), keys, "left")
            .withColumn(name, sure).sortWithinPartitions("_vg_mono")
            .drop("_vg_file", "_vg_block", "_vg_len", "_vg_fh", "_vg_mono", "_vg_first", "_len", "_n", "_off"))
