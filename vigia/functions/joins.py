"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a dimension may have and still be shipped whole to every task.
DEFAULT_BROADCAST_ROWS = 200_000


# Bytes of them at most (text counts in full, every other column as 8 bytes).
DEFAULT_BROADCAST_BYTES = 64 << 20


def fits(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and about ``max_bytes``
    bytes.  One aggregate with a partial sum per partition: a single row per
    partition is shuffled, however many rows there are."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{n}`")), F.lit(0)) if t == "string" else F.lit(8)
                 for n, t in df.dtypes), F.lit(0))
    got = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width.cast("long")).alias("bytes")).first()
    return got["rows"] <= max_rows and (got["bytes"] or 0) <= max_bytes


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, materialize: bool = False,
                    known_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when it is proven small, else ``df`` unchanged so the
    planner (and AQE at run time) chooses a shuffle join.

    ``materialize`` checkpoints a *derived* frame first (to the shared
    checkpoint folder), so the size check and the join read the same computed
    rows instead of evaluating the frame twice.  Frames read from storage do
    not need it.  ``known_rows`` (e.g. observed while the frame was written)
    replaces the check."""
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    if materialize:
        from ..session import shared_dir
        shared_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    return F.broadcast(df) if fits(df, max_rows) else df
