"""Hard negatives by lists that the anchors of a cluster share.

1. Anchors are clustered by direction around centroids fitted on a bounded
   sample; a cluster's radius is the largest angle between a member and the
   centroid.
2. For every member a of a cluster, a row x scores at most |a| |x| cos(max(0,
   angle of x to the centroid - radius)).  The rows a cluster may need are sorted
   by |x| cos(..) once, as a list shared by all members.
3. Every member walks the list from its start and keeps its best rows.  It is
   done, with proof, when |a| times the bound of the next row is less than the
   worst score that it would still take.  The worst scores that a bounded sample
   of rows proves beforehand decide which rows enter a list at all.
4. First walk: positives, the best rows of the anchor's own label.  Second walk: negatives, for
   each positive the best rows of other labels whose scores lie in its band.

Scores are exact integers.  Long lists are dealt to parts and many members to
slices; a task streams the part of one list for one slice, already sorted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .rows import stage

POSITIVES, NEGATIVES, SCALE = 5, 3, 256
#: A negative's score lies between these hundredths of its positive's.
BAND = (50, 95)
#: Anchors of a cluster, about; clusters at most; anchors of a slice.
CLUSTER, CLUSTERS, SLICE = 128, 1024, 1024
#: Rows of the samples that centroids are fitted on (a cluster) and that prove first scores.
FIT, PROOF = 8, 2048
#: Rows of a list that are scored at a time.
CHUNK = 1024
LEAST = -(1 << 63)


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """A list column of integers as a matrix, shorter rows filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), d), dtype=np.int64)
    out[np.arange(d) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


@dataclass
class Shape:
    """Length of the longest vector and largest component."""
    d: int
    most: int

    @property
    def kind(self) -> np.dtype:
        return next(np.dtype(t) for t in (np.int16, np.int32, np.int64) if self.most <= np.iinfo(t).max)

    def packed(self, x: np.ndarray) -> pa.Array:
        """Rows of a matrix as binary values."""
        n, width = len(x), self.d * self.kind.itemsize
        return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int64) * width),
                                                            pa.py_buffer(x.astype(self.kind).tobytes())])

    def unpacked(self, column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), self.kind).reshape(len(column), self.d).astype(np.int64)

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact inner products of the rows of a and b; one beyond 64 bits raises."""
        if self.d * self.most * self.most < 1 << 53:
            return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
        out = a.astype(object) @ b.T.astype(object)
        if out.size and max(out.max(), -out.min()) > np.iinfo(np.int64).max:
            raise OverflowError("a score does not fit into 64 bits")
        return out.astype(np.int64)


def norms(x: np.ndarray) -> np.ndarray:
    return np.linalg.norm(x.astype(np.float64), axis=1)


def centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Directions of k clusters of the rows (spherical k-means)."""
    x = x.astype(np.float64)
    length = np.linalg.norm(x, axis=1)
    x = x[length > 0] / length[length > 0, None]
    if not len(x):
        return np.zeros((k, max(1, x.shape[1])))
    at = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        near = np.argmax(x @ at.T, axis=1)
        total = np.zeros_like(at)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1)
        at = np.where(size[:, None] > 0, total / np.where(size > 0, size, 1)[:, None], at)
    return at


def angles(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Angles of the rows of x to the centroids; 0 for rows without direction."""
    length = norms(x)
    cos = (x.astype(np.float64) @ at.T) / np.where(length > 0, length, 1)[:, None]
    return np.where(length[:, None] > 0, np.arccos(np.clip(cos, -1, 1)), 0.0)


class Best:
    """The best k (score, id) of each slot, better scores and smaller ids first."""

    def __init__(self, slots: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.slot, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def put(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(p) for p in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        start = np.searchsorted(slot, slot)
        place = np.arange(len(slot)) - start
        keep = place < self.k
        self.slot, self.score, self.id, place = slot[keep], score[keep], ids[keep], place[keep]
        full = place == self.k - 1
        self.floor[self.slot[full]] = np.maximum(self.floor[self.slot[full]], self.score[full])


class Walk:
    """Members of one slice on their way along one list.

    ``low``, ``high``, ``floor``: of each member's bands the least and greatest
    score, and a score that the worst one taken is known to reach."""

    def __init__(self, shape: Shape, ids, labels, x, low, high, floor, same: bool, k: int):
        self.shape, self.ids, self.labels, self.x, self.same = shape, ids, labels, x, same
        self.bands = np.array([len(b) for b in low])
        self.first = np.cumsum(self.bands) - self.bands
        self.low, self.high = (np.array([v for b in c for v in b], dtype=np.int64) for c in (low, high))
        self.best = Best(len(self.low), k, np.array([v for b in floor for v in b], dtype=np.int64))
        self.norm = norms(x)
        self.live = np.flatnonzero(self.bands > 0)

    def step(self, bound: float, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> bool:
        """Take the next rows of the list, none above ``bound``; False: all
        members are done."""
        if len(self.live):
            need = np.minimum.reduceat(self.best.floor, self.first[self.live]) if len(self.live) == len(self.first) else \
                np.array([self.best.floor[f:f + n].min() for f, n in zip(self.first[self.live], self.bands[self.live], strict=True)])
            self.live = self.live[self.norm[self.live] * bound * (1 + 1e-9) + 1e-6 >= need]
        if not len(self.live):
            return False
        score = self.shape.scores(self.x[self.live], x)
        usable = ((self.labels[self.live][:, None] == labels) == self.same) & (self.ids[self.live][:, None] != ids)
        for band in range(int(self.bands[self.live].max())):
            has = np.flatnonzero(self.bands[self.live] > band)
            slot = self.first[self.live[has]] + band
            s = score[has]
            m, j = np.nonzero(usable[has] & (s >= np.maximum(self.low, self.best.floor)[slot][:, None])
                              & (s <= self.high[slot][:, None]))
            self.best.put(slot[m], s[m, j], ids[j])
        return True

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Member, band, id and score of all that is kept."""
        member = np.repeat(np.arange(len(self.bands)), self.bands)[self.best.slot]
        return member, self.best.slot - self.first[member], self.best.id, self.best.score


_LIST = "cluster int, slice int, part int, kind int, bound double, id long, label long, vec binary"
_BANDS = "low array<long>, high array<long>, floor array<long>"


def listed(rows: DataFrame, shape: Shape, at: np.ndarray, radius: np.ndarray, cutoff: np.ndarray, slices: np.ndarray,
           parts: int) -> DataFrame:
    """The lists: every row for each cluster whose members may need it, with
    its bound (once for each slice of the members)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                ids, labels, vec = batch.slice(start, CHUNK).columns
                x = matrix(vec, shape.d)
                bounds = norms(x)[:, None] * np.cos(np.maximum(0.0, angles(x, at) - radius))
                bounds += 1e-9 * np.abs(bounds)
                i, c = np.nonzero(bounds >= cutoff)
                n = slices[c]
                which = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                i, c = np.repeat(i, n), np.repeat(c, n)
                names = ids.to_numpy()
                part = (names[i].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32()), pa.array(which, pa.int32()), pa.array(part.astype(np.int32)),
                     pa.array(np.ones(len(i), dtype=np.int32)), pa.array(bounds[i, c]), ids.take(pa.array(i)),
                     labels.take(pa.array(i)), shape.packed(x).cast(pa.binary()).take(pa.array(i))],
                    names=["cluster", "slice", "part", "kind", "bound", "id", "label", "vec"])
    return rows.select("id", "label", "vec").mapInArrow(run, _LIST)


def walked(members: DataFrame, rows: DataFrame, shape: Shape, at: np.ndarray, radius: np.ndarray, parts: int, same: bool,
           k: int) -> DataFrame:
    """(anchor, band, id, score): the best k rows in each band of each member
    (id, label, vec, cluster, low, high, floor), of each part of the lists."""
    spans = {r["cluster"]: r for r in members.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.min("cut").alias("cut")).collect()}  # CLUSTERS rows at most
    # clusters without members take no rows
    cutoff = np.array([spans[c]["cut"] if c in spans else np.inf for c in range(len(at))])
    slices = np.array([-(-spans[c]["n"] // SLICE) if c in spans else 0 for c in range(len(at))], dtype=np.int64)
    many = F.array(*[F.lit(int(s)) for s in slices])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            cols["vec"] = shape.packed(matrix(cols["vec"], shape.d)).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    own = members.select(
        "cluster", F.pmod(F.xxhash64("id"), F.element_at(many, F.col("cluster") + 1)).cast("int").alias("slice"),
        F.lit(0).alias("kind"), F.lit(float("inf")).alias("bound"), "id", "label", "vec", "low", "high", "floor").mapInArrow(
            packed, f"cluster int, slice int, kind int, bound double, id long, label long, vec binary, {_BANDS}")
    own = own.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    both = own.unionByName(listed(rows, shape, at, radius, cutoff, slices, parts), allowMissingColumns=True)
    keys = ["cluster", "slice", "part"]
    dealt = (both.select(*keys, "kind", "bound", "id", "label", "vec", "low", "high", "floor").repartition(*keys)
             .sortWithinPartitions(*keys, "kind", F.desc("bound"), "id"))
    schema = pa.schema([("anchor", pa.int64()), ("band", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def result(walk: Walk | None) -> Iterator[pa.RecordBatch]:
        if walk is not None:
            m, band, ids, score = walk.found()
            yield pa.RecordBatch.from_arrays([pa.array(walk.ids[m]), pa.array(band, pa.int32()), pa.array(ids),
                                              pa.array(score)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, walk, held, done = None, None, [], False
        for batch in batches:
            where = np.stack([batch.column(i).to_numpy() for i in range(4)])
            cuts = [0, *(np.flatnonzero((np.diff(where) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if i == j:
                    continue
                here, kind = tuple(where[:3, i].tolist()), where[3, i]
                if here != unit:
                    yield from result(walk)
                    unit, walk, held, done = here, None, [], False
                if kind == 0:
                    held.append(batch.slice(i, j - i))
                    continue
                if done or not held and walk is None:
                    continue
                if walk is None:
                    t = pa.Table.from_batches(held).combine_chunks()
                    walk = Walk(shape, t["id"].to_numpy(), t["label"].to_numpy(), shape.unpacked(t["vec"]),
                                *(t[c].to_pylist() for c in ("low", "high", "floor")), same, k)
                    held = []
                for start in range(i, j, CHUNK):
                    part = batch.slice(start, min(CHUNK, j - start))
                    if not walk.step(part.column(4)[0].as_py(), part.column(5).to_numpy(), part.column(6).to_numpy(),
                                     shape.unpacked(part.column(7))):
                        done = True
                        break
        yield from result(walk)

    return dealt.mapInArrow(run, "anchor long, band int, id long, score long")


def with_cut(members: DataFrame) -> DataFrame:
    """The bound that a row must reach to matter to a member."""
    need = F.array_min("floor").cast("double")
    return members.withColumn("cut", F.when((F.array_min("floor") == LEAST) | (F.col("norm") == 0), F.lit(float("-inf")))
                              .otherwise(need / F.col("norm") * (1 - 1e-9) - F.lit(1e-6) / F.col("norm")))


def proven(members: DataFrame, shape: Shape, proof: tuple[np.ndarray, ...], same: bool, k: int) -> DataFrame:
    """``members`` with ``floor``: of each band the k-th best score in the sample,
    its least one if the sample has fewer."""
    ids, labels, x = proof

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                col = lambda n: part.column(part.schema.get_field_index(n))  # noqa: B023, E731
                low = col("low").to_pylist()
                walk = Walk(shape, col("id").to_numpy(), col("label").to_numpy(), matrix(col("vec"), shape.d), low,
                            col("high").to_pylist(), low, same, k)
                if len(ids):
                    walk.step(np.inf, ids, labels, x)
                cuts = np.append(walk.first, len(walk.low))
                floor = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(walk.best.floor))
                yield pa.RecordBatch.from_arrays([*part.columns, floor], names=[*part.schema.names, "floor"])

    return with_cut(members.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in members.dtypes) + ", floor array<long>"))


def mine(rows: DataFrame, anchors, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "vec",
         positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = BAND, cluster: int = CLUSTER,
         proof: int = PROOF, parts: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score: for each of the first ``positives`` rows of an anchor's
    label, the first ``negatives`` rows of other labels whose score is within
    ``band`` hundredths of the positive's.  Higher scores come first, ties by
    smaller id; ``anchors`` is a condition over ``id_col``.

    Vectors are arrays of integers; shorter ones count as filled up with zeros,
    zero and empty vectors score 0.  Rows with a null id, label, vector or
    component take no part; rows that repeat an id count once, as the one of
    smallest label, then vector.  Scores are exact; one beyond 64 bits raises.  An
    anchor without positives or without negatives in a band has no row there; an
    empty table gives none.  Other columns are not read."""
    x = F.col("x")
    keyed = (rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.struct(
        F.col(f"`{label_col}`").cast("long").alias("label"), F.col(f"`{vec_col}`").cast("array<long>").alias("vec")).alias("x"))
        .where(F.col("id").isNotNull() & x["label"].isNotNull() & x["vec"].isNotNull()
               & ~F.exists(x["vec"], lambda v: v.isNull()))
        .groupBy("id").agg(F.min("x").alias("x")))
    all_rows = stage(keyed.select("id", x["label"].alias("label"), x["vec"].alias("vec")), "rows")
    size = all_rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d"), F.max(F.greatest(
        F.array_max("vec").cast("decimal(20)"), -F.array_min("vec").cast("decimal(20)"))).alias("most")).first()
    shape, n = Shape(max(1, size["d"] or 0), int(size["most"] or 0)), size["n"]
    parts = parts or max(1, min(-(-n // 4096), max(64, -(-n // 131_072))))
    chosen = all_rows.where(anchors(F.col("id")))
    k = min(CLUSTERS, max(1, -(-chosen.count() // cluster)))

    def sample(df: DataFrame, most: int) -> tuple[np.ndarray, ...]:
        got = df.orderBy(F.xxhash64("id"), "id").limit(most).toArrow().combine_chunks()
        column = lambda c: got[c].combine_chunks() if len(got) else pa.array([], got.schema.field(c).type)
        return column("id").to_numpy(), column("label").to_numpy(), matrix(column("vec"), shape.d)

    at = centroids(sample(chosen, FIT * k)[2], k)
    seen = sample(all_rows, proof)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(2), shape.d)
            angle = angles(v, at)
            near = angle.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.int32()), pa.array(angle[np.arange(len(near)), near]),
                 pa.array(norms(v))], names=["id", "label", "vec", "cluster", "angle", "norm"])

    members = stage(chosen.mapInArrow(assign, "id long, label long, vec array<long>, cluster int, angle double, norm double"),
                    "anchors")
    radius = np.zeros(k)
    for r in members.groupBy("cluster").agg(F.max("angle").alias("r")).collect():
        radius[r["cluster"]] = r["r"] + 1e-9
    every = lambda v: F.array(F.lit(v).cast("long"))
    first = stage(proven(members.withColumns({"low": every(LEAST), "high": every((1 << 63) - 1)}), shape, seen, True,
                         positives), "first")
    better = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    taken = (walked(first, all_rows, shape, at, radius, parts, True, positives)
             .withColumn("place", F.row_number().over(better)).where(F.col("place") <= positives))
    of_anchor = taken.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("p"))
    score = lambda e: e["score"].cast("decimal(20)")
    bands = of_anchor.select(
        F.col("anchor").alias("id"), "p",
        F.transform("p", lambda e: F.ceil(score(e) * band[0] / 100).cast("long")).alias("low"),
        F.transform("p", lambda e: F.floor(score(e) * band[1] / 100).cast("long")).alias("high"))
    second = stage(proven(members.join(bands, "id").select("id", "label", "vec", "cluster", "norm", "p", "low", "high"),
                          shape, seen, False, negatives), "second")
    in_band = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "id")
    kept = (walked(second, all_rows, shape, at, radius, parts, False, negatives)
            .withColumn("rank", F.row_number().over(in_band)).where(F.col("rank") <= negatives))
    named = second.select(F.col("id").alias("anchor"), F.posexplode("p").alias("band", "e"))
    return kept.join(named, ["anchor", "band"]).select(
        F.col("anchor").alias("anchor_id"), F.col("e.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), F.col("e.score").alias("positive_score"), F.col("score").alias("negative_score"))


def report(vectors: DataFrame) -> DataFrame:
    """Hard negatives of every 50th vector: components times ``SCALE``, rounded
    down; every 7th row's label moved on by one.  Rows with a null label, vector
    or a null or non-finite component take no part; see :func:`mine`."""
    x = F.col("embedding").cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.where(usable).select(
        "vec_id", label.alias("label"), F.transform(x, lambda v: F.floor(v * float(SCALE))).alias("vec"))
    return mine(rows, lambda i: i % 50 == 0)
