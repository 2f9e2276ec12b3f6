"""Benchmark decontamination with an FM-index per training shard.

1. Test phrases: all windows of ``WINDOW`` consecutive words of an item (an item
   of fewer words is one window).  Their words are the alphabet; every other
   word of a document is a separator, since no phrase can hold it.
2. A task indexes its rows in shards.  What is left between separators is cut
   into blocks that overlap by a window less one word, each with an end sign of
   its own, so that suffixes are told apart within a block; prefix doubling sorts
   them.  The Burrows-Wheeler transform is held as a wavelet matrix.
3. All phrases are searched backward side by side: a step maps both ends of
   every phrase's range by two ranks of the wavelet matrix.
4. Occurrences are located by walking back to the nearest sampled suffix, marked
   in their documents, and neighbouring or overlapping ones merged to spans.

A word is a run of ASCII letters and digits and of all other code points beyond
ASCII, A-Z in lower case.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import attach, free_name, stage

WINDOW = 10
#: Words of a shard and of a block at most; every so many places of a block a suffix is sampled.
SHARD, BLOCK, SAMPLE = 1 << 19, 256, 8
#: Bytes of test items that are searched at a time (and broadcast).
ITEM_BYTES = 16 << 20
#: Occurrences located at a time.
LOCATED = 1 << 20
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Bytes of separators become blanks, A-Z lower case; bytes of other code points stay.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_PLAIN).split()


class WaveletMatrix:
    """Ranks and symbols of a sequence of numbers, many at a time."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = []
        at = symbols
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            ones = (at >> bit) & 1
            before = np.zeros(len(at) + 1, dtype=np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(at) - int(before[-1])))
            at = np.concatenate([at[ones == 0], at[ones == 1]])
        every = np.arange(sigma)
        self.first = self._down(every, np.zeros(sigma, dtype=np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for bit, before, zeros in self.levels:
            ones = before[i]
            i = np.where((c >> bit) & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c[k] stands among the first i[k] symbols."""
        return self._down(c, i) - self.first[c]

    def symbol(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at places i, and how often each stands before."""
        c = np.zeros(len(i), dtype=np.int64)
        for bit, before, zeros in self.levels:
            ones = before[i]
            one = before[i + 1] > ones
            c |= one.astype(np.int64) << bit
            i = np.where(one, zeros + ones, i - ones)
        return c, i - self.first[c]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes of a text of numbers in order; zeros are end signs, each less
    than all that follow it and than any other symbol.  Doubles the number of
    symbols compared until all suffixes differ."""
    n, ends = len(text), text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum())).astype(np.int64)
    h = 1
    while True:
        key = rank * (int(rank.max()) + 2)
        key[:n - h] += rank[h:] + 1
        order = np.argsort(key)
        new = np.ones(n, dtype=np.int64)
        new[0] = 0
        new[1:] = key[order][1:] != key[order][:-1]
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == n - 1:
            return order
        h *= 2


class FMIndex:
    """Index of blocks of numbers 1..sigma-1, each followed by a zero."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = SAMPLE):
        order = suffix_order(text)
        self.n = len(text)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])[:sigma]
        self.last = WaveletMatrix(text[order - 1].astype(np.int64), sigma)
        ends = np.flatnonzero(text == 0)
        start = np.concatenate([[0], ends[:-1] + 1])
        in_block = np.arange(self.n) - np.repeat(start, ends + 1 - start)
        sampled = (in_block % sample == 0)[order]  # a block's first place too: no walk leaves its block
        self.sampled, self.sample_no, self.places = sampled, np.cumsum(sampled) - 1, order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of the suffixes that start with each phrase (a row of
        the matrix)."""
        count = len(phrases)
        lo, hi = np.zeros(count, dtype=np.int64), np.full(count, self.n, dtype=np.int64)
        live = np.arange(count)
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, j]
            lo[live] = self.below[c] + self.last.rank(c, lo[live])
            hi[live] = self.below[c] + self.last.rank(c, hi[live])
            live = live[hi[live] > lo[live]]
        found = np.zeros(count, dtype=bool)
        found[live] = True
        return np.where(found, lo, 0), np.where(found, hi, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of some rows."""
        out = np.empty(len(rows), dtype=np.int64)
        at, who, steps = rows, np.arange(len(rows)), 0
        while len(who):
            done = self.sampled[at]
            out[who[done]] = self.places[self.sample_no[at[done]]] + steps
            at, who, steps = at[~done], who[~done], steps + 1
            c, before = self.last.symbol(at)
            at = self.below[c] + before
        return out


class Phrases:
    """The windows of some items: the alphabet, the distinct windows by length
    and the items of each."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        self.symbols: dict[bytes, int] = {}
        self.names = sorted({i for i, _ in items if i is not None})
        number = {name: k for k, name in enumerate(self.names)}
        by_length: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for name, text in items:
            w = [self.symbols.setdefault(x, len(self.symbols) + 1) for x in words(text)]
            size = min(window, len(w))
            for at in range(len(w) - size + 1 if size else 0):
                owners = by_length.setdefault(size, {}).setdefault(tuple(w[at:at + size]), set())
                if name is not None:
                    owners.add(number[name])
        self.lengths = []
        for size, found in sorted(by_length.items()):
            owners = [sorted(x) for x in found.values()]
            cuts = np.cumsum([0, *map(len, owners)])
            self.lengths.append((size, np.array(list(found), dtype=np.int64).reshape(-1, size), cuts,
                                 np.array([k for x in owners for k in x], dtype=np.int64)))


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .. of every range, one after another."""
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)


def shards(ids: np.ndarray, least: int, overlap: int, size: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, place of each symbol in ids) of the shards: stretches of ``least``
    numbers without a zero, in overlapping blocks."""
    inside = np.concatenate([[0], (ids != 0).astype(np.int8), [0]])
    turn = np.diff(inside)
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    keep = end - start >= least
    start, end = start[keep], end[keep]
    step = block - overlap
    parts = np.maximum(1, -(-(end - start - overlap) // step))
    lo = ranges(np.zeros(len(start), dtype=np.int64), parts) * step + np.repeat(start, parts)
    hi = np.minimum(lo + block, np.repeat(end, parts))
    taken = np.cumsum(hi - lo + 1)
    cuts = [0, *(np.flatnonzero(np.diff(taken // size)) + 1).tolist(), len(lo)]
    for i, j in zip(cuts, cuts[1:], strict=False):
        if j > i:
            places = ranges(lo[i:j], hi[i:j] - lo[i:j] + 1)
            places_end = np.cumsum(hi[i:j] - lo[i:j] + 1) - 1
            text = ids[np.minimum(places, len(ids) - 1)]
            text[places_end] = 0
            yield text, places


def search(texts: list[bytes | None], phrases: Phrases, size: int = SHARD, block: int = BLOCK) -> list[dict]:
    """n_words, spans and items of each text."""
    get, listed, start = phrases.symbols.get, [], []
    for text in texts:
        start.append(len(listed))
        listed += [get(w, 0) for w in words(text)]
        listed.append(0)
    ids, start = np.array(listed, dtype=np.int64), np.array(start, dtype=np.int64)
    n_words = np.diff(np.append(start, len(ids))) - 1
    marks, owned = np.zeros(len(ids) + 1, dtype=np.int64), [np.zeros((0, 2), dtype=np.int64)]
    if phrases.lengths:
        most = phrases.lengths[-1][0]
        for text, places in shards(ids, phrases.lengths[0][0], most - 1, size, max(block, 2 * most)):
            index = FMIndex(text, len(phrases.symbols) + 1)
            for length, windows, cuts, owners in phrases.lengths:
                lo, hi = index.search(windows)
                which = np.flatnonzero(hi > lo)
                lo, count = lo[which], (hi - lo)[which]
                ends = np.cumsum(count)
                for first in range(0, int(ends[-1]) if len(ends) else 0, LOCATED):
                    hit = np.arange(first, min(first + LOCATED, int(ends[-1])))
                    w = np.searchsorted(ends, hit, side="right")
                    at = places[index.locate(lo[w] + hit - (ends - count)[w])]
                    at, w = np.unique(np.stack([at, which[w]]), axis=1)  # blocks overlap
                    np.add.at(marks, at, 1)
                    np.subtract.at(marks, at + length, 1)
                    pairs = np.unique(np.stack([np.searchsorted(start, at, side="right") - 1, w]), axis=1)
                    n = (cuts[1:] - cuts[:-1])[pairs[1]]
                    owned.append(np.stack([np.repeat(pairs[0], n), owners[ranges(cuts[pairs[1]], n)]], axis=1))
    turn = np.diff(np.concatenate([[0], (np.cumsum(marks)[:-1] > 0).astype(np.int8), [0]]))
    lo, hi = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    doc = np.searchsorted(start, lo, side="right") - 1
    out = [{"n_words": n, "spans": [], "items": []} for n in n_words.tolist()]
    for d, a, b in zip(doc.tolist(), (lo - start[doc]).tolist(), (hi - start[doc]).tolist(), strict=True):
        out[d]["spans"].append({"start": a, "end": b})
    for d, item in np.unique(np.concatenate(owned), axis=0).tolist():
        out[d]["items"].append(phrases.names[item])
    return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, most: int) -> tuple[DataFrame, int]:
    """Distinct items (name, text, block) and the number of blocks: about
    ``most`` bytes are in each."""
    named = items.select(F.col(f"`{id_col}`").cast("string").alias("name"),
                         F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null").distinct()
    size = named.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // most))
    return named.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks))), blocks


_FOUND = "struct<n_words:bigint,spans:array<struct<start:int,end:int>>,items:array<string>>"


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", out_col: str = "contamination", window: int = WINDOW,
                  item_bytes: int = ITEM_BYTES, keep_text: bool = True, shard: int = SHARD,
                  block: int = BLOCK) -> DataFrame:
    """``docs`` with ``out_col``, a struct: n_words, spans (start, end
    exclusive, in words: what occurring windows cover, merged) and items (ids of
    items with an occurring window, as sorted strings).

    Null and empty texts have no words, in documents and items alike; a
    document of fewer words than a window can only hold shorter items.  Rows
    count one by one, also those that repeat; items that repeat count once, and
    an item without an id marks words but is not listed.  Without items nothing
    is contaminated; an empty table gives no rows.  All other columns pass
    through; a clashing ``out_col`` raises.

    Items are broadcast in blocks of about ``item_bytes``; with several blocks
    the documents pass one after another, each pass written and read again."""
    if free_name(docs, out_col) != out_col:
        raise ValueError(f"column {out_col} exists already")
    named, blocks = item_blocks(items, item_id, item_text, item_bytes)
    sc = docs.sparkSession.sparkContext

    def searched(df: DataFrame, number: int, name: str, keep: bool) -> DataFrame:
        rows = named.where(F.col("block") == number).select("name", F.col("text").cast("binary").alias("t")).collect()
        shared = sc.broadcast(Phrases([(r["name"], bytes(r["t"])) for r in rows], window))

        def make():
            phrases = shared.value

            def run(texts: pa.Array) -> list:
                return search(texts.cast(pa.string()).cast(pa.binary()).to_pylist(), phrases, shard, block)
            return run
        return attach(df, text_col, name, _FOUND, make, rows=4096, arrow=True, keep=keep)

    if blocks == 1:
        return searched(docs, 0, out_col, keep_text)
    out = searched(docs, 0, out_col, True)
    for number in range(1, blocks):
        more = free_name(out, "_more")
        out = searched(stage(out, "decontaminate"), number, more, True)
        both = F.struct(
            F.col(f"`{out_col}`.n_words"),
            merged(F.concat(F.col(f"`{out_col}`.spans"), F.col(f"{more}.spans"))).alias("spans"),
            F.array_sort(F.array_union(F.col(f"`{out_col}`.items"), F.col(f"{more}.items"))).alias("items"))
        out = out.withColumn(out_col, both).drop(more)
    return out if keep_text else out.drop(F.col(f"`{text_col}`"))


def merged(spans):
    """An array of spans, sorted, those that touch or overlap made one."""
    kind = "array<struct<start:int,end:int>>"
    last = lambda done: F.element_at(done, -1)
    return F.aggregate(
        F.array_sort(spans), F.array().cast(kind),
        lambda done, s: F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]),
                               F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                                        F.array(F.struct(last(done)["start"].alias("start"),
                                                         F.greatest(last(done)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(s))).cast(kind))


def without_spans(text: str | None, spans: list) -> str | None:
    """The text without the words of the spans and what lies between them."""
    if not text or not spans:
        return text
    at = [m.span() for m in _WORD.finditer(text)]
    out, done = [], 0
    for s in spans:
        out.append(text[done:at[s["start"]][0]])
        done = at[s["end"] - 1][1]
    return "".join([*out, text[done:]])


def remove(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the words of test items: the text without its spans (see
    :func:`contamination`), all other rows and columns as they are."""
    found = free_name(docs, "_contamination")
    marked = contamination(docs, items, text_col, out_col=found, **options)
    pair, cut = free_name(marked, "_pair"), free_name(marked, "_cut")
    both = marked.withColumn(pair, F.struct(F.col(f"`{text_col}`").cast("string").alias("text"),
                                            F.col(f"{found}.spans").alias("spans")))

    def make():
        return lambda rows: [without_spans(r["text"], r["spans"]) for r in rows]
    done = attach(both, pair, cut, "string", make)
    return done.select(*[F.col(cut).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words within occurring
    windows), n_items, items_sha256 (of the sorted item ids, comma-joined),
    contaminated.  Other columns are not read; see :func:`contamination`."""
    found = contamination(docs.select("doc_id", "text"), items, keep_text=False, **options)
    x = F.col("contamination")
    hit = F.aggregate(x["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", x["n_words"].alias("n_words"), hit.alias("n_hit"),
                        F.size(x["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(x["items"], ","), 256).alias("items_sha256"),
                        (F.size(x["spans"]) > 0).alias("contaminated"))
