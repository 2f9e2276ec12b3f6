"""SimHash near-duplicates by BK-trees.

1. Fingerprints: 64 bits, each set if it is set in over half the hashes of the
   text's shingles (:func:`fingerprint`).
2. Equal fingerprints are one node.  Two fingerprints at most r bits apart
   agree in two of r + 2 blocks of their bits, so nodes meet under the key of
   every pair of blocks.
3. A key's nodes are dealt to shards of about ``SHARD``; each shard, and each
   pair of shards, is one unit of work: its task builds a BK-tree (children
   keyed by the integer distance to their parent) of one shard and asks it for
   the other's nodes, following only edges within the radius.  A hot key is
   many units, and no task holds more than two shards, so trees are built where
   they are asked instead of being broadcast, which would grow with the corpus.
4. A unit returns a spanning forest of the links it found; components follow.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .rows import attach, sorted_groups, stage

SHINGLE, RADIUS, BITS, SHARD = 3, 2, 64, 512
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Words: runs of bytes other than ASCII white space, A-Z lowered;
    shingles: ``shingle`` words joined by a space, repeats included (fewer
    words: all of them; none, or a null text: 0); hashes: XXH64, seed 42."""
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    count = np.zeros(BITS, dtype=np.int64)
    spans = list(zip(starts[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist(), strict=True))
    for at in range(0, n, 4096):
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans[at:at + 4096]], dtype=">u8")
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > n).view(">i8")[0])


class BKTree:
    """Integers by Hamming distance.  A node: [value, {distance: child}]."""

    def __init__(self):
        self.root: list | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while d := (value ^ node[0]).bit_count():
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            node = todo.pop()
            d = (value ^ node[0]).bit_count()
            if d <= radius:
                found.append(node[0])
            children = node[1]
            for edge in range(max(1, d - radius), d + radius + 1):
                child = children.get(edge)
                if child is not None:
                    todo.append(child)
        return found


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> None:
        a, b = sorted((self.root(x), self.root(y)))
        if a != b:
            self.up[b] = a


def unit_links(values: list[int], shards: list[int], first: int, second: int, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within shard ``first`` (== ``second``) or
    between the two shards."""
    tree, forest = BKTree(), Forest()
    unsigned = [v & (2**BITS - 1) for v in values]
    signed = dict(zip(unsigned, values, strict=True))
    if first == second:
        for u in unsigned:
            for v in tree.within(u, radius):
                forest.join(u, v)
            tree.add(u)
    else:
        for u, s in zip(unsigned, shards, strict=True):
            if s == first:
                tree.add(u)
        for u, s in zip(unsigned, shards, strict=True):
            if s == second:
                for v in tree.within(u, radius):
                    forest.join(u, v)
    return [(signed[x], signed[forest.root(x)]) for x in list(forest.up) if forest.root(x) != x]


def link_forest(nodes: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``nodes.fp``
    (distinct longs) at most ``radius`` bits apart."""
    cuts = [round(i * BITS / (radius + 2)) for i in range(radius + 3)]
    masks = []
    for i, j in combinations(range(radius + 2), 2):
        mask = sum(((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k] for k in (i, j))
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    keyed = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("blocks"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
        for i, m in enumerate(masks)])).alias("k")).select("k.blocks", "k.key", "fp")
    shared = keyed.groupBy("blocks", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shards = F.ceil(F.col("n") / shard).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("shards")).cast("int")
    units = (keyed.join(shared, ["blocks", "key"]).withColumn("shards", shards).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
             .select(F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
                     "blocks", "key", "own", "fp"))
    keys = ["blocks", "key", "first", "second"]
    parted = units.select(*keys, "own", "fp").repartition(*keys).sortWithinPartitions(*keys)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for _, _, first, second, own, fp in sorted_groups(batches, 4):
            out += unit_links(fp.tolist(), own.tolist(), int(first[0]), int(second[0]), radius)
            if len(out) > 50_000:
                yield _links(out)
                out = []
        yield _links(out)

    return parted.mapInArrow(links, "a long, b long")


def _links(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits),
    component_id, the smallest id reachable over links of at most ``radius``
    differing bits.

    Null and empty texts have the fingerprint 0 and link like any other.  A
    null id stays null and is no component's name unless it has no other.
    Repeated rows get a row each; an empty table gives no rows; other columns
    are not read."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    prints = stage(attach(rows, "text", "fp", "long", lambda: lambda ts: [fingerprint(t, shingle) for t in ts])
                   .select("doc_id", "fp"), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = connected_components(link_forest(nodes, radius, shard))
    grouped = (nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    named = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = stage(grouped.join(named, "root").select("fp", "component_id"), "classes")
    return (prints.join(classes, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(doc_id, text_hash): of every component the row of smallest id, then of
    smallest xxhash64 of the text.  Components are of texts, whatever ids
    repeat; rows with a null id stand for none."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    prints = stage(attach(rows, "text", "fp", "long", lambda: lambda ts: [fingerprint(t, shingle) for t in ts])
                   .select("doc_id", "fp", F.xxhash64("text").alias("text_hash")), "fingerprints")
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash")))
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), least.alias("least")), "nodes")
    roots = connected_components(link_forest(nodes.select("fp", "first_id"), radius, shard))
    return (nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("least"))
            .where("least is not null").select("least.doc_id", "least.text_hash"))
