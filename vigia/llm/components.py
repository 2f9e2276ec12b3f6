"""Connected components of a link table, as a series of contractions."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import drop_stage, stage


def connected_components(links: DataFrame, seed: int = 42) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b: long): nodes
    have the same root exactly if links join them.

    A round moves every node to its smallest neighbour (or itself), rewrites
    the links between the new nodes, and drops loops and repeats.  Every other
    round orders nodes by an exclusive-or with a random mask instead, which
    keeps long chains from shrinking by one node a round.  The moves of a round
    are a table; at the end they are followed one after another.  Nulls and
    self-links are ignored, an empty table gives no rows.  Nothing is collected
    but the row count of the links that remain."""
    rng = random.Random(seed)
    live = stage(links.where("a is not null and b is not null and a <> b")
                 .select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b"))
                 .distinct(), "links")
    moves: list[DataFrame] = []
    mask = 0
    while live.count():
        key = lambda c: F.col(c).bitwiseXOR(F.lit(mask).cast("long"))  # noqa: E731, B023
        both = live.select("a", "b").union(live.select(F.col("b"), F.col("a")))
        move = stage(both.groupBy("a").agg(F.min(key("b")).alias("least"))
                     .select(F.col("a").alias("node"),
                             F.least("least", key("a")).bitwiseXOR(F.lit(mask).cast("long")).alias("to")), "moves")
        moves.append(move)
        a, b = move.toDF("a", "to_a"), move.toDF("b", "to_b")
        after = stage(live.join(a, "a").join(b, "b").where("to_a <> to_b")
                      .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
                      .distinct(), "links")
        drop_stage(live)
        live = after
        mask = 0 if mask else rng.getrandbits(62)
    drop_stage(live)
    if not moves:
        return links.sparkSession.createDataFrame([], "node long, root long")
    roots = moves[0].withColumnRenamed("to", "root")
    for move in moves[1:]:
        step = move.toDF("root", "to")
        roots = roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return roots
