"""Embedding near-duplicates by NN-descent.

1. Equal vectors are one node that counts as often as they occur.
2. First neighbour lists: signs of random projections deal the nodes to
   buckets of about ``BUCKET`` in as many tables as a pair at the threshold
   needs to meet with probability ``MEET``; the best ``NEIGHBOURS`` of a bucket
   enter a node's list.  Buckets with more than twice as many nodes are split
   by the signs of further projections around the bucket's own mean; only what
   these leave together is dealt to random parts.
3. Descent: the neighbours of a node's neighbours are compared with it, until
   the lists stop changing.  Lists hold neighbours within twice the
   threshold's angle, the farthest that two nodes linked to a third can be.
4. Saturated lists (all ``NEIGHBOURS`` are links) may lack links, but only to
   nodes whose lists are saturated too: saturated nodes of different components
   are compared block by block, wherever the blocks' centres and radii allow a
   link, and a link joins the components.
5. A component with a saturated node is compared with itself block by block,
   which returns counts, not pairs.
6. Audit: a bounded sample of nodes is compared with all nodes; as long as
   counts and components hold less than ``RECALL`` of its links, more tables are
   added, and after ``ATTEMPTS`` all nodes are compared block by block.
7. Links of cosine >= the threshold (double precision) make the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .rows import attach, sorted_groups, stage

THRESHOLD, NEIGHBOURS, BUCKET, MEET, RECALL = 0.9, 12, 256, 0.998, 0.98
AUDIT, ATTEMPTS, BLOCK = 128, 3, 512


# Vectors whose largest component is outside this range are scaled: their squares
# would overflow or vanish.
SMALLEST, LARGEST = 1e-100, 1e100


def scaled(vec: Column) -> Column:
    """A finite vector of the same direction whose norm is a double: very large
    and very small ones are multiplied by a power of two, the others as given.
    In two steps, as the power itself may not be a double."""
    top = F.array_max(F.transform(vec, lambda y: F.abs(y)))
    power = -F.floor(F.log2(top))
    half = F.floor(power / 2)
    two = lambda n: F.pow(F.lit(2.0), n)
    return (F.when(top.between(SMALLEST, LARGEST), vec)
            .otherwise(F.transform(vec, lambda y: y * two(half) * two(power - half))))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All cosines of the rows of a and b, in double precision."""
    return (a @ b.T) / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))


def _rows(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as a matrix of doubles."""
    n = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(n, -1)


def _pairs(out: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    cat = lambda i, t: np.concatenate([o[i] for o in out]) if out else np.zeros(0, t)
    return pa.RecordBatch.from_arrays([pa.array(cat(0, np.int64)), pa.array(cat(1, np.int64)),
                                       pa.array(cat(2, np.float64))], names=["v", "u", "cosine"])


def meeting_tables(bits: int, threshold: float, meet: float) -> int:
    p = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if p >= meet else math.ceil(math.log(1 - meet) / math.log(1 - p))


def bucket_pairs(nodes: DataFrame, n: int, floor: float, threshold: float, first_table: int, tables: int,
                 bits: int, neighbours: int, bucket: int) -> DataFrame:
    """(v, u, cosine): each node's best neighbours in each of its buckets."""

    extra = max(1, bits)

    def make():
        planes: dict[int, np.ndarray] = {}

        def codes(vectors: list) -> list:
            out = []
            for x in vectors:
                d = len(x)
                if d not in planes:
                    planes[d] = np.random.default_rng([d, first_table]).normal(size=(d, 2 * tables * extra))
                x = np.array(x, dtype=np.float64)
                at = (x @ planes[d] / np.linalg.norm(x)).reshape(2, tables, extra)
                code = (at[0] > 0) @ (1 << np.arange(extra, dtype=np.int64)) if bits else np.zeros(tables, np.int64)
                # vectors of other lengths meet nowhere
                out.append([{"code": c, "more": m} for c, m in zip((code * 65_536 + d % 65_536).tolist(), at[1].tolist(),
                                                                   strict=True)])
            return out
        return codes

    coded = (attach(nodes.select("v", "vec"), "vec", "codes", "array<struct<code:bigint,more:array<double>>>", make,
                    rows=2048)
             .select("v", "vec", F.posexplode("codes").alias("table", "c")).select("v", "vec", "table", "c.code", "c.more"))
    full = (coded.groupBy("table", "code")
            .agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(F.col("more")[i]) for i in range(extra)]).alias("mean"))
            .where("n > 1"))
    # a hot bucket is split by as many signs around its mean as it needs
    signs = F.aggregate(F.zip_with("more", "mean", lambda a, m: (a > m).cast("long")), F.lit(0).cast("long"),
                        lambda code, sign: code * 2 + sign)
    halvings = F.least(F.ceil(F.log2(F.col("n") / bucket)), F.lit(extra)).cast("int")
    split = stage(coded.join(full, ["table", "code"])
                  .withColumn("sub", F.when(F.col("n") > 2 * bucket, signs % F.pow(F.lit(2), halvings).cast("long")).otherwise(F.lit(0)).cast("long"))
                  .select("table", "code", "sub", "n", "v", "vec"), "buckets")
    parts = (split.where(F.col("n") > 2 * bucket).groupBy("table", "code", "sub").agg(F.count(F.lit(1)).alias("left"))
             .where(F.col("left") > 2 * bucket)
             .select("table", "code", "sub", F.ceil(F.col("left") / bucket).alias("parts")))
    dealt = (split.join(parts, ["table", "code", "sub"], "left")
             .withColumn("part", F.pmod(F.xxhash64("v", "table"), F.coalesce("parts", F.lit(1))).cast("int"))
             .select("table", "code", "sub", "part", "v", "vec"))
    by = ["table", "code", "sub", "part"]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, _, _, _, v, vec in sorted_groups(batches, 4):
            x = np.stack(vec).astype(np.float64)
            for at in range(0, len(v), BLOCK):
                c = cosines(x[at:at + BLOCK], x)
                c[np.arange(len(c)), np.arange(at, at + len(c))] = -2
                k = min(neighbours, len(v) - 1)
                if k:
                    near = np.argpartition(-c, k - 1, axis=1)[:, :k]
                    cos = np.take_along_axis(c, near, axis=1)
                    i, j = np.nonzero(cos >= floor)
                    out.append((v[at + i], v[near[i, j]], cos[i, j]))
            if len(out) > 200:
                yield _pairs(out)
                out = []
        yield _pairs(out)

    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(best, "v long, u long, cosine double")


def nearest(lists: DataFrame | None, pairs: DataFrame, neighbours: int) -> DataFrame:
    """(v, u, cosine, fresh): the best neighbours of each node, from its list
    so far and pairs of either direction; fresh: not in the list so far."""
    both = pairs.select("v", "u", "cosine").union(pairs.select("u", "v", "cosine")).withColumn("fresh", F.lit(True))
    if lists is not None:
        both = lists.withColumn("fresh", F.lit(False)).select(both.columns).union(both)
    both = both.groupBy("v", "u").agg(F.max("cosine").alias("cosine"), F.min("fresh").alias("fresh"))
    place = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("cosine"), "u"))
    return both.withColumn("place", place).where(F.col("place") <= neighbours).drop("place")


def pair_cosines(pairs: DataFrame, nodes: DataFrame, floor: float) -> DataFrame:
    """``pairs`` (v, u) with their cosine, where it is ``floor`` or more."""
    joined = (pairs.join(nodes.select("v", F.col("vec").alias("a")), "v")
              .join(nodes.select(F.col("v").alias("u"), F.col("vec").alias("b")), "u")
              .where(F.size("a") == F.size("b")).select("v", "u", "a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, u = (batch.column(i).to_numpy() for i in range(2))
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            out = []
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                a, b = (_rows(batch.column(i).take(pa.array(at))) for i in (2, 3))
                c = np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
                near = c >= floor
                out.append((v[at][near], u[at][near], c[near]))
            yield _pairs(out)

    return joined.mapInArrow(run, "v long, u long, cosine double")


def audited_recall(nodes: DataFrame, classes: DataFrame, n: int, threshold: float, sample: int) -> float:
    """Share of the links of at most ``sample`` nodes, found by comparing them
    with all nodes, that ``classes`` (v, root, n) holds: within the node's
    component, and as many as it counts."""
    every = max(1, n // sample)
    picked = [(r["v"], np.array(r["vec"], dtype=np.float64)) for r in
              nodes.where(F.pmod(F.xxhash64("v", F.lit(3)), F.lit(every)) == 0).limit(sample).collect()]  # bounded
    if not picked:
        return 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(0).to_numpy()
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            out = []
            for d in np.unique(sizes):
                own = [(i, x) for i, x in picked if len(x) == d]
                if own:
                    at = np.flatnonzero(sizes == d)
                    c = cosines(np.array([x for _, x in own]), _rows(batch.column(1).take(pa.array(at))))
                    i, j = np.nonzero(c >= threshold)
                    a, b = np.array([i for i, _ in own])[i], v[at][j]
                    out.append((a[a != b], b[a != b], c[i, j][a != b]))
            yield _pairs(out)

    links = nodes.select("v", "vec").mapInArrow(run, "v long, u long, cosine double").select("v", "u")
    per = (links.join(classes, "v")
           .join(classes.select(F.col("v").alias("u"), F.col("root").alias("u_root")), "u")
           .join(nodes.select(F.col("v").alias("u"), "weight"), "u").groupBy("v")
           .agg(F.sum("weight").alias("links"), F.first("n").alias("n"),
                F.sum(F.when(F.col("root") == F.col("u_root"), F.col("weight")).otherwise(0)).alias("joined"))
           .collect())  # bounded by the sample
    total = sum(r["links"] for r in per)
    return sum(min(r["n"], r["joined"]) for r in per) / total if total else 1.0


def block_counts(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """(v, n): for each node the weight of the nodes of its group linked to
    it.  ``members``: (root, parts, v, weight, vec); every two parts of a group
    are one unit of work."""
    dealt = (members.withColumn("own", F.pmod(F.xxhash64("v", F.lit(5)), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("root", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
                     "own", "v", "weight", "vec"))
    by = ["root", "first", "second"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, first, second, own, v, weight, vec in sorted_groups(batches, 3):
            count = np.zeros(len(v), dtype=np.int64)
            sizes = np.array([len(x) for x in vec])
            for d in np.unique(sizes):
                a = np.flatnonzero((own == first[0]) & (sizes == d))
                b = np.flatnonzero((own == second[0]) & (sizes == d))
                if len(a) and len(b):
                    xb, wb = np.stack(vec[b]).astype(np.float64), weight[b]
                    for at in range(0, len(a), block):
                        part = a[at:at + block]
                        near = cosines(np.stack(vec[part]).astype(np.float64), xb) >= threshold
                        if first[0] == second[0]:
                            near[np.arange(len(part)), np.searchsorted(b, part)] = False
                        else:
                            count[b] += weight[part] @ near
                        count[part] += near @ wb
            yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(count)], names=["v", "n"])

    counted = dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "v long, n long")
    return counted.groupBy("v").agg(F.sum("n").alias("n"))


def cells(members: DataFrame) -> DataFrame:
    """(root, part, radius, center): the parts of ``members`` (root, part, v,
    vec), with the direction of their mean and the widest angle to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for root, part, _, vec in sorted_groups(batches, 2):
            x = np.stack(vec).astype(np.float64)  # of one length: links join no others
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            center = x.mean(axis=0)
            center = center / np.linalg.norm(center) if np.linalg.norm(center) > 1e-9 else x[0]
            radius = float(np.arccos(np.clip(x @ center, -1, 1)).max())
            yield pa.RecordBatch.from_arrays(
                [pa.array(root[:1]), pa.array(part[:1]), pa.array([radius]), pa.array([center.tolist()])],
                names=["root", "part", "radius", "center"])

    by = ["root", "part"]
    return (members.select("root", "part", "v", "vec").repartition(*by).sortWithinPartitions(*by)
            .mapInArrow(run, "root long, part int, radius double, center array<double>"))


def cell_pairs(found: DataFrame, threshold: float, block: int) -> DataFrame:
    """(a_root, a_part, b_root, b_part): cells of different roots that centres
    and radii allow a link between."""
    chunks = max(1, math.ceil(found.count() / block))
    dealt = (found.withColumn("own", F.pmod(F.xxhash64("root", "part", F.lit(7)), F.lit(chunks)).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
             .select(F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
                     "own", "root", "part", "radius", "center"))
    by, far = ["first", "second"], math.acos(threshold) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, second, own, root, part, radius, center in sorted_groups(batches, 2):
            out = [(np.zeros(0, np.int64), np.zeros(0, np.int32)) * 2]
            sizes = np.array([len(x) for x in center])
            for d in np.unique(sizes):
                a = np.flatnonzero((own == first[0]) & (sizes == d))
                b = np.flatnonzero((own == second[0]) & (sizes == d))
                if len(a) and len(b):
                    angle = np.arccos(np.clip(cosines(np.stack(center[a]), np.stack(center[b])), -1, 1))
                    near = (angle <= radius[a][:, None] + radius[b] + far) & (root[a][:, None] != root[b])
                    if first[0] == second[0]:
                        near &= root[a][:, None] < root[b]
                    i, j = np.nonzero(near)
                    out.append((root[a[i]], part[a[i]], root[b[j]], part[b[j]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                             names=["a_root", "a_part", "b_root", "b_part"])

    return (dealt.repartition(*by).sortWithinPartitions(*by)
            .mapInArrow(run, "a_root long, a_part int, b_root long, b_part int"))


def joining_roots(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """(a, b): roots of ``members`` (root, v, vec) that a link of two members
    joins, by comparing the parts of different roots block by block."""
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    dealt = stage(members.join(sizes, "root")
                  .withColumn("part", F.pmod(F.xxhash64("v", F.lit(5)), F.col("parts")).cast("int"))
                  .select("root", "part", "v", "vec"), "saturated")
    pairs = stage(cell_pairs(stage(cells(dealt), "cells"), threshold, block), "cell_pairs")
    by = ["a_root", "a_part", "b_root", "b_part"]
    sides = [pairs.join(dealt.toDF(f"{s}_root", f"{s}_part", "v", "vec"), [f"{s}_root", f"{s}_part"])
             .select(*by, F.lit(s == "b").cast("int").alias("side"), "vec") for s in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, _, b, _, side, vec in sorted_groups(batches, 4):
            x, y = (np.stack(vec[side == k]).astype(np.float64) for k in (0, 1))
            if any((cosines(x[at:at + block], y) >= threshold).any() for at in range(0, len(x), block)):
                yield pa.RecordBatch.from_arrays([pa.array(a[:1]), pa.array(b[:1])], names=["a", "b"])

    return (sides[0].union(sides[1]).repartition(*by).sortWithinPartitions(*by)
            .mapInArrow(run, "a long, b long").distinct())


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Rows and columns of a link matrix that join what all its links join."""
    left, out = np.ones(near.shape[1], dtype=bool), []
    todo_rows = np.ones(near.shape[0], dtype=bool)
    for start in np.flatnonzero(near.any(axis=1)):
        if not todo_rows[start]:
            continue
        todo_rows[start] = False
        rows = [start]
        while rows:
            i = rows.pop()
            for j in np.flatnonzero(near[i] & left):
                left[j] = False
                out.append((i, j))
                more = np.flatnonzero(near[:, j] & todo_rows)
                todo_rows[more] = False
                out += [(k, j) for k in more]
                rows += more.tolist()
    return out


def block_links(nodes: DataFrame, n: int, threshold: float, block: int) -> DataFrame:
    """(a, b): links that join what all links of ``nodes`` join, from comparing
    every two of their parts."""
    parts = max(1, math.ceil(n / block))
    dealt = (nodes.withColumn("own", F.pmod(F.xxhash64("v", F.lit(5)), F.lit(parts)).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
             .select(F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "own", "v", "vec"))
    by = ["first", "second"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, second, own, v, vec in sorted_groups(batches, 2):
            a_out, b_out = [], []
            sizes = np.array([len(x) for x in vec])
            for d in np.unique(sizes):
                a = np.flatnonzero((own == first[0]) & (sizes == d))
                b = np.flatnonzero((own == second[0]) & (sizes == d))
                if len(a) and len(b):
                    near = cosines(np.stack(vec[a]).astype(np.float64), np.stack(vec[b]).astype(np.float64)) >= threshold
                    for i, j in forest(near):
                        a_out.append(v[a[i]])
                        b_out.append(v[b[j]])
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a long, b long").where("a <> b")


def by_blocks(nodes: DataFrame, n: int, threshold: float, block: int) -> DataFrame:
    """(v, root, n): all nodes compared with all, without lists."""
    roots = connected_components(block_links(nodes, n, threshold, block)).withColumnRenamed("node", "v")
    whole = nodes.select(F.lit(0).alias("root"), F.lit(max(1, math.ceil(n / block))).alias("parts"), "v", "weight", "vec")
    return stage(nodes.select("v").join(roots, "v", "left").join(block_counts(whole, threshold, block), "v", "left")
                 .select("v", F.coalesce("root", "v").alias("root"), F.coalesce("n", F.lit(0)).alias("n")), "classes")


def by_lists(nodes: DataFrame, lists: DataFrame, threshold: float, neighbours: int, block: int) -> DataFrame:
    """(v, root, n): components, and the weight of the nodes linked to each
    node: by lists, and by blocks in components that hold a saturated node."""
    links = lists.where(F.col("cosine") >= threshold)
    roots = connected_components(links.select(F.col("v").alias("a"), F.col("u").alias("b")))
    roots = roots.select(F.col("node").alias("v"), "root")
    per = (links.join(nodes.select(F.col("v").alias("u"), "weight"), "u").groupBy("v")
           .agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("held")))
    counted = stage(roots.join(per, "v", "left").select("v", "root", "n", F.coalesce("held", F.lit(0)).alias("held")),
                    "counts")
    saturated = counted.where(F.col("held") >= neighbours)
    if saturated.select("root").distinct().limit(2).count() == 2:
        joined = connected_components(joining_roots(saturated.join(nodes, "v").select("root", "v", "vec"),
                                                    threshold, block))
        joined = joined.select(F.col("node").alias("root"), F.col("root").alias("to"))
        counted = stage(counted.join(joined, "root", "left")
                        .select("v", F.coalesce("to", "root").alias("root"), "n", "held"), "counts")
    dense = (counted.groupBy("root").agg(F.max("held").alias("held"), F.count(F.lit(1)).alias("size"))
             .where(F.col("held") >= neighbours)
             .select("root", F.ceil(F.col("size") / block).cast("int").alias("parts")))
    members = counted.join(dense, "root").join(nodes, "v").select("root", "parts", "v", "weight", "vec")
    blocks = block_counts(members, threshold, block).withColumnRenamed("n", "dense_n")
    # a dense component's nodes count by blocks, the others by their lists
    return stage(nodes.select("v").join(counted, "v", "left").join(blocks, "v", "left")
                 .select("v", F.coalesce("root", "v").alias("root"), F.coalesce("dense_n", "n", F.lit(0)).alias("n")),
                 "classes")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS, bucket: int = BUCKET,
                    meet: float = MEET, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per input row: vec_id, n_links (other rows linked directly),
    component_id (smallest id reachable by links), kept (its own component's
    name).

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, nor do vectors of different lengths.  Components may be of
    any size that a double holds.  Rows with a null
    id link with nothing, have a null component and are not kept.  Repeated
    rows count as vectors of their own.  An empty table gives no rows; other
    columns are not read."""
    x = F.col("vec")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                          F.col(f"`{vec_col}`").cast("array<double>").alias("vec"))
    finite = F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("vec_id").isNotNull() & (F.size(x) > 0) & finite
                        & F.exists(x, lambda y: y != 0), F.lit(False))
    even = rows.select("vec_id", F.when(usable, scaled(x)).alias("vec"))
    keyed = stage(even.select("vec_id", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")).alias("v"), "vec"), "vectors")
    nodes = stage(keyed.where("v is not null").groupBy("v", "vec")
                  .agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first_id")), "nodes")
    n = nodes.count()
    floor = 2 * threshold * threshold - 1
    bits = max(0, math.ceil(math.log2(max(1, n) / bucket)))
    tables = meeting_tables(bits, threshold, meet)
    lists, held = None, 0.0
    for attempt in range(ATTEMPTS):
        found = bucket_pairs(nodes, n, floor, threshold, attempt * tables, tables, bits, neighbours, bucket)
        lists = descend(nodes, stage(nearest(lists, found, neighbours), "lists"), threshold, floor, neighbours)
        classes = by_lists(nodes, lists, threshold, neighbours, block)
        held = audited_recall(nodes, classes, n, threshold, AUDIT)
        if held >= recall:
            break
    if held < recall:
        classes = by_blocks(nodes, n, threshold, block)
    named = nodes.join(classes, "v").select("v", "first_id", "weight", "root", "n")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = stage(named.join(least, "root")
                    .select("v", (F.col("n") + F.col("weight") - 1).alias("n_links"), "component_id"), "classes")
    out = keyed.select("vec_id", "v").join(classes, "v", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def descend(nodes: DataFrame, lists: DataFrame, threshold: float, floor: float, neighbours: int) -> DataFrame:
    """Rounds of comparing nodes with their neighbours' neighbours, until no
    list changes; what two entries of earlier rounds lead to was compared then.
    Saturated nodes don't ask: links between them are found block by block."""
    while lists.where("fresh").limit(1).count():
        asking = (lists.groupBy("v").agg(F.sum(F.when(F.col("cosine") >= threshold, 1).otherwise(0)).alias("links"))
                  .where(F.col("links") < neighbours).select("v"))
        to = lists.select(F.col("v").alias("via"), F.col("u"), F.col("fresh").alias("also"))
        ask = lists.join(asking, "v", "left_semi").select("v", F.col("u").alias("via"), "fresh")
        candidates = (ask.join(to, "via").where("v <> u and (fresh or also)").select("v", "u").distinct()
                      .join(lists.select("v", "u"), ["v", "u"], "left_anti"))
        lists = stage(nearest(lists, pair_cosines(candidates, nodes, floor), neighbours), "lists")
    return lists
