"""Periodic runs of words by seeds and extended diagonals.

A run is a stretch of words of smallest period q, at least ``max(LEAST, TIMES *
q)`` long, that no neighbouring word extends.

1. Periods are taken by powers of two.  A run of period q in [2^j, 2^(j+1)) agrees
   with itself shifted by q over at least 3 q words, so the k-gram of k = 2^(j+1)
   words at its start, the least overlap that every such run is sure to have,
   occurs again q words on, and nowhere between: a nearer occurrence would give
   the run a smaller period.  So next occurrences are enough, one pair a place.
2. k-grams are numbered exactly, 2k-grams from the numbers of two k-grams that
   both occur again in their document; the others are left behind.
3. A pair of occurrences with its lag within the range is extended to both sides along its
   diagonal.  A table of the furthest covered place per lag suppresses pairs
   within an extension that was made before.

A word is a run of characters other than blank, tab, line feed, vertical tab,
form feed and carriage return.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import attach

LEAST, TIMES = 6, 4
_FOUND = "struct<n_words:bigint,runs:array<struct<start:int,length:int,period:int>>,collapsed:string>"


def word_table(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and where each text's start
    (one more than there are texts)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, cuts = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    cuts -= cuts[0]
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    return words.filter(pa.array(real)), np.concatenate([[0], np.cumsum(real)])[cuts]


def numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal keys numbered alike: (order, by key and place; number in that
    order; whether the key occurs again)."""
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key) + 1, dtype=bool)
    new[1:-1] = key[order][1:] != key[order][:-1]
    return order, np.cumsum(new[:-1]) - 1, ~(new[:-1] & new[1:])


def agreeing(x: np.ndarray, a: int, b: int, most: int, step: int) -> int:
    """How many of at most ``most`` words from places a and b on agree, going
    by ``step`` (1: right, -1: left)."""
    done, chunk = 0, 32
    while done < most:
        n = min(chunk, most - done)
        u, v = a + step * done, b + step * done
        same = x[u:u + n] == x[v:v + n] if step > 0 else (x[u - n + 1:u + 1] == x[v - n + 1:v + 1])[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done, chunk = done + n, chunk * 2
    return done


def runs(x: np.ndarray, cuts: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """All runs of several texts: rows (text, start in x, length, period), in
    order.  ``x``: the numbers of their words; text i is x[cuts[i]:cuts[i + 1]]."""
    if times < 4 or least < 2:
        raise ValueError("a run's overlap with itself is only sure from four periods and two words on")
    n, found = len(x), []
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    order, number, again = numbered(text * (int(x.max(initial=0)) + 1) + x)
    at = order[again]  # places whose k-gram occurs again in their text, and its number
    name = np.full(n, -1, dtype=np.int64)
    name[at] = number[again]
    k, longest = 1, int(np.diff(cuts).max(initial=0))
    while len(at) and 2 * k <= longest:
        # the 2k-gram from two k-grams; both occur again, or the whole cannot
        at = np.sort(at)
        at = at[at + k < n]
        at = at[(name[at + k] >= 0) & (text[at] == text[at + k])]
        key = name[at] * n + name[at + k]
        order, number, again = numbered(key)
        name = np.full(n, -1, dtype=np.int64)
        place, number = at[order[again]], number[again]
        name[place] = number
        at, low, k = place, k, 2 * k
        lag = place[1:] - place[:-1]
        seed = np.flatnonzero((number[1:] == number[:-1]) & (lag >= low) & (lag < k))
        start, lag = place[seed], lag[seed]
        by = np.lexsort((start, lag))
        start, lag = start[by], lag[by]
        # seeds side by side on one diagonal are one
        first = np.ones(len(start), dtype=bool)
        first[1:] = (np.diff(start) != 1) | (np.diff(lag) != 0)
        covered: dict[tuple[int, int], int] = {}
        for i, q in zip(start[first].tolist(), lag[first].tolist(), strict=True):
            t = int(text[i])
            if covered.get((t, q), -1) > i:
                continue
            lo, hi = int(cuts[t]), int(cuts[t + 1])
            left = agreeing(x, i - 1, i - 1 + q, i - lo, -1)
            right = agreeing(x, i, i + q, hi - i - q, 1)
            covered[t, q] = i + right
            if left + right + q >= max(least, times * q):
                found.append((t, i - left, left + right + q, q))
    return np.array(sorted(found), dtype=np.int64).reshape(-1, 4)


def periodic(texts: pa.Array) -> pa.Array:
    """n_words, runs and collapsed text of each text."""
    words, cuts = word_table(texts)
    found = runs(words.dictionary_encode().indices.to_numpy().astype(np.int64), cuts)
    count = len(texts)
    t, start, length, period = found.T
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.subtract.at(change, start + length, 1)
    kept = np.cumsum(change)[:-1] == 0
    left = np.concatenate([[0], np.cumsum(kept)])[cuts]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(kept))), " ")
    each = pa.StructArray.from_arrays(
        [pa.array(c, pa.int32()) for c in (start - cuts[t], length, period)], names=["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(t, np.arange(count + 1)), pa.int32()), each)
    return pa.StructArray.from_arrays([pa.array(np.diff(cuts)), lists, collapsed.cast(pa.string())],
                                      names=["n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, text_col: str = "text", out_col: str = "periodic", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``out_col``, a struct: n_words, runs (start, length, period,
    in words, by start, then period) and collapsed: the words, joined by single
    blanks, without those that a run holds after its first period.

    Null and empty texts have no words and no runs, and collapse to the empty
    text.  Rows count one by one, also those that repeat; all other columns pass
    through, a clashing ``out_col`` raises, and an empty table gives no rows."""
    def make():
        return lambda texts: periodic(texts.cast(pa.string()))
    return attach(docs, text_col, out_col, _FOUND, make, rows=1024, arrow=True, keep=keep_text)


def collapse(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every run cut down to its first period; texts without a
    run stay as they are."""
    out = find_runs(docs, text_col, "_periodic")
    text = F.when(F.size("_periodic.runs") > 0, F.col("_periodic.collapsed")).otherwise(F.col(f"`{text_col}`"))
    return out.withColumn(text_col, text).drop("_periodic")


def planted(doc_id: Column, text: Column) -> Column:
    """The text of every tenth document (by crc32 of its id), its words from one
    place on being made a repetition of the first of them; others as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    w = F.array_remove(F.split(text, "[ \t-\r]+"), "")
    n = F.size(w).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    repeated = F.flatten(F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")),
                                        (1 + F.floor((n - a) / p)).cast("int")))
    made = F.concat(F.slice(w, F.lit(1), a.cast("int")), F.slice(repeated, F.lit(1), (n - a).cast("int")))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(made, " ")).otherwise(text)


def report(docs: DataFrame) -> DataFrame:
    """One row per document, its text edited by :func:`planted`: doc_id, n_runs;
    start, length, period, exponent_milli of the longest run (ties: smallest
    start, then period; null without a run); runs_sha256 (every run's
    ``start,length,period`` and a line feed), collapsed_sha256.  A null id plants
    nothing.  Other columns are not read; see :func:`find_runs`."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = find_runs(rows.withColumn("text", planted(F.col("doc_id"), F.col("text"))), keep_text=False)
    x = F.col("periodic")
    by_length = F.transform(x["runs"], lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"]))
    lines = F.transform(x["runs"], lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = F.col("best")
    return found.withColumn("best", F.try_element_at(F.array_sort(by_length), F.lit(1))).select(
        "doc_id", F.size(x["runs"]).cast("long").alias("n_runs"), best["start"].cast("long").alias("start"),
        (-best["less"]).cast("long").alias("length"), best["period"].cast("long").alias("period"),
        F.floor(F.lit(1000) * -best["less"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(x["collapsed"], 256).alias("collapsed_sha256"))
