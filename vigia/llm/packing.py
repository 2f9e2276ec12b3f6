"""Packing of token sequences: dominance reduction, then best fit.

Which bins are built depends only on how many pieces of each length there are,
and that histogram has at most ``capacity`` rows at any input size.  So:

1. tasks cut and count pieces, and number the pieces of each length they make;
2. the histogram is packed (:func:`plan`): the reduction of Martello and Toth
   fixes sets that dominate every other feasible set of the largest piece, and
   best fit decreasing packs the rest; equal bins are kept as one pattern with
   a multiplicity, so neither depends on the number of pieces;
3. a piece's number among all pieces of its length (its task's offset plus its
   number there) says which bin and which place it gets.

The packing is that of one global run, though no task ever sees more than its
own pieces; only the histogram and the patterns reach the driver.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import TextEncoder
from .rows import lasting, stage, text_or_empty, tidy

CAPACITY = 1024
Bins = list[tuple[int, tuple[int, ...]]]


def reduce(counts: dict[int, int], capacity: int) -> tuple[Bins, dict[int, int]]:
    """Fixed bins and the counts that remain.

    Largest length first, a set with it is fixed if it dominates every feasible
    set: alone if nothing fits beside it; with the piece that fills the bin;
    with the largest piece that fits, if no two fit or no two together exceed
    it while no three fit; with the two that bound every other pair, if no
    three fit.  Removing pieces never makes a new set feasible, so a set is
    fixed as often as its pieces last."""
    left = {w: n for w, n in counts.items() if n > 0}
    fixed: Bins = []

    def take(items: tuple[int, ...]) -> None:
        need = Counter(items)
        times = min(left[w] // n for w, n in need.items())
        for w, n in need.items():
            left[w] -= times * n
            if not left[w]:
                del left[w]
        fixed.append((times, items))

    for j in sorted(left, reverse=True):
        while left.get(j, 0):
            room = capacity - j
            # what is there beside one piece of length j
            rest = {w: n - (w == j) for w, n in left.items() if w <= room and n - (w == j) > 0}
            if not rest:
                take((j,))
                continue
            sizes = sorted(rest)
            single = sizes[-1]
            if single == room:
                take((j, single))
                continue
            smallest = [w for w in sizes[:3] for _ in range(min(3, rest[w]))][:3]
            if len(smallest) < 2 or smallest[0] + smallest[1] > room:
                take((j, single))
                continue
            if len(smallest) == 3 and sum(smallest) <= room:
                break  # sets of four: not looked at
            pairs = [(a, b) for a in sizes
                     if (b := max((w for w in sizes if a <= w <= room - a and (w != a or rest[a] > 1)),
                                  default=0))]
            if max(a + b for a, b in pairs) <= single:
                take((j, single))
                continue
            b = max(b for _, b in pairs)
            a = max(w for w in sizes if w <= room - b and (w != b or rest[b] > 1))
            if single <= b and all(min(p) <= min(a, b) and max(p) <= max(a, b) for p in pairs):
                take((j, a, b))
                continue
            break
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> Bins:
    """Best fit decreasing over a histogram: every piece goes to the open bin
    with the least room that still takes it, else to a new bin."""
    open_bins: dict[int, Counter] = defaultdict(Counter)  # room -> pattern -> bins
    for w in sorted(counts, reverse=True):
        n = counts[w]
        for room in [r for r in sorted(open_bins) if r >= w]:
            # all bins of this room take one piece each, then are emptier bins' better
            todo = open_bins[room]
            while n and todo:
                items, bins = next(iter(todo.items()))
                fit = room // w  # a bin that took one piece is the best fit for the next
                full = min(bins, n // fit)
                for times, k in ((full, fit), (1 if full < bins and n % fit and full == n // fit else 0, n % fit)):
                    if times and k:
                        todo[items] -= times
                        open_bins[room - k * w][items + (w,) * k] += times
                        n -= times * k
                if not todo[items]:
                    del todo[items]
            if not todo:
                del open_bins[room]
            if not n:
                break
        if n:
            fit = capacity // w
            if n // fit:
                open_bins[capacity - fit * w][(w,) * fit] += n // fit
            if n % fit:
                open_bins[capacity - n % fit * w][(w,) * (n % fit)] += 1
    return [(times, items) for todo in open_bins.values() for items, times in todo.items() if times]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Bins:
    """(multiplicity, lengths) of the bins that pack the histogram."""
    if any(w < 1 or w > capacity for w in counts):
        raise ValueError("lengths must be 1 to the capacity")
    fixed, left = reduce(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(bins: Bins) -> dict[int, dict[str, np.ndarray]]:
    """For each length, which numbers go where: number r with start <= r lies
    in bin base + (r - start) // per, at offset + (r - start) % per * length."""
    rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    seen: Counter = Counter()
    base = 0
    for times, items in bins:
        offset = 0
        for w, per in sorted(Counter(items).items(), reverse=True):
            rows[w].append((seen[w], base, per, offset))
            seen[w] += times * per
            offset += per * w
        base += times
    return {w: dict(zip(("start", "base", "per", "offset"), np.array(r, dtype=np.int64).T, strict=True))
            for w, r in rows.items()}


def byte_of() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes
    stand for themselves, the others for 256, 257, ... in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary_encoder(path: str):
    """text -> ids as ``Tokenizer.from_file(path).encode(text,
    add_special_tokens=False)``.

    The file's tokenizer is byte-level BPE without normaliser, whose vocabulary
    is numbered in merge order: every match of its pattern is encoded by
    itself, so the ids of a match are looked up in a memo.  Texts that hold an
    added token's string go through the library as a whole."""
    import json

    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    pre = said["pre_tokenizer"]
    whole = Tokenizer.from_file(path)
    if (said["normalizer"] or said["model"]["type"] != "BPE" or pre["type"] != "ByteLevel"
            or pre["add_prefix_space"] or not pre["use_regex"]):
        return lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<i4")
    added = [t["content"] for t in said["added_tokens"]]
    code = byte_of()
    ranks = {bytes(map(code.__getitem__, t)): i for t, i in said["model"]["vocab"].items() if t not in added}
    merges = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = TextEncoder(BYTE_LEVEL_PATTERN, lambda piece: tuple(merges.encode_ordinary(piece)))

    def encode(text: str) -> np.ndarray:
        if any(t in text for t in added):
            return np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<i4")
        return encoder.ids(text)
    return encode


#: Fixed value: the pattern of byte-level pre-tokenizers.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; all but the first are full."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Token pieces of all documents, each numbered within its task and length
    (``task``, ``number``); ``ids`` are returned if ``keep_ids``."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("task", pa.int32()), ("number", pa.int64()),
                        *([("ids", pa.list_(pa.int32()))] if keep_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = lasting((vocabulary, "packing"), lambda: vocabulary_encoder(vocabulary))
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py()), end_id).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start:start + length]
                    row = (doc_id, k, start, length, zlib.crc32(part.tobytes()), task, seen[length])
                    out.append((*row, part.astype(np.int32)) if keep_ids else row)
                    seen[length] += 1
            columns = list(zip(*out, strict=True)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    ddl = ("doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"
           + (", ids array<int>" if keep_ids else ""))
    return rows.mapInArrow(tidy(run), ddl)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids),
    sequence_id, offset.

    Null or empty text: one piece with the end id.  Repeated rows are packed
    once per row, null ids stay null, an empty table gives no rows; other
    columns are not read.  Pieces of one length are interchangeable, so ties
    are settled by where a piece was cut and don't change the number of
    sequences."""
    cut_rows = stage(pieces(docs, vocabulary, end_id, capacity, id_col, text_col, keep_ids), "pieces")
    per_task = cut_rows.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # bounded: a row for each possible length
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = places(plan(histogram, capacity))

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def place(batches):
        for frame in batches:
            sequence = np.empty(len(frame), dtype=np.int64)
            offset = np.empty(len(frame), dtype=np.int64)
            for length, at in frame.groupby("length").indices.items():
                w, number = where[length], frame["rank"].to_numpy()[at]
                row = np.searchsorted(w["start"], number, side="right") - 1
                beyond = number - w["start"][row]
                sequence[at] = w["base"][row] + beyond // w["per"][row]
                offset[at] = w["offset"][row] + beyond % w["per"][row] * length
            yield frame.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    ranked = (cut_rows.join(offsets, ["task", "length"])
              .select(*kept, (F.col("before") + F.col("number")).alias("rank")))
    types = dict(ranked.dtypes)
    return ranked.mapInPandas(place, ", ".join(f"{c} {types[c]}" for c in kept) + ", sequence_id long, offset long")
