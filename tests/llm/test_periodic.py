"""Periodic runs against trying every lag."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigia.llm import periodic as pr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, least=6, times=4):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, times * q):
                body = w[i:i + length]
                if all(any(body[k] != body[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def edited(doc_id, text):
    w, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def opened(value):
    return [(r["start"], r["length"], r["period"]) for r in value]


def test_random_words():
    rng = np.random.default_rng(3)
    texts = []
    for size in [0, 1, 2, 5, 6, 7, 8, 9, 40, 60, 90] * 12:
        w = [f"w{i}" for i in rng.integers(0, int(rng.integers(1, 5)), size)]
        if size >= 40:  # plant a long period among others
            p, a = int(rng.integers(1, size // 3)), int(rng.integers(0, size // 3))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(size)]
        texts.append(" ".join(w))
    got = pr.periodic(pa.array(texts)).to_pylist()
    for text, g in zip(texts, got, strict=True):
        w = text.split()
        want = plain_runs(w)
        assert (g["n_words"], opened(g["runs"]), g["collapsed"]) == (len(w), want, collapsed(w, want)), text
    assert sum(len(g["runs"]) for g in got) > 40


@pytest.mark.parametrize("text, want", [
    ("a a a a a", []), ("a a a a a a", [(0, 6, 1)]), ("x b a b a b a b a y", [(1, 8, 2)]), ("b a b a b a b", []),
    ("a b a b a b a b a c a b a b a b a b", [(0, 9, 2), (10, 8, 2)]),
    ("p q r p q r p q r p q r p s", [(0, 13, 3)]),
    ("a a a a a a b a a a a a a b a a a a a a b a a a a a a b", [(0, 6, 1), (0, 28, 7), (7, 6, 1), (14, 6, 1), (21, 6, 1)])])
def test_named_runs(text, want):
    got = pr.periodic(pa.array([text, None, text])).to_pylist()
    assert opened(got[0]["runs"]) == want == opened(got[2]["runs"])
    assert got[1] == {"n_words": 0, "runs": [], "collapsed": ""}


def test_words_are_cut_at_six_characters_only():
    text = " a b\x1cc\x85d e\t\nf\x0b\x0cg\r  h　 "
    words, cuts = pr.word_table(pa.array([text, "", None, "z"]))
    assert words.to_pylist() == [*WORD.findall(text), "z"] and cuts.tolist() == [0, 4, 4, 4, 5]


def test_query_whole_table(spark, docs):
    got = {r["doc_id"]: r for r in pr.report(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows) == docs.count()
    for r in rows:
        w = edited(r["doc_id"], r["text"])
        if len(w) > 1500:  # the plain way is too slow
            continue
        want, g = plain_runs(w), got[r["doc_id"]]
        best = min(want, key=lambda x: (-x[1], x[0], x[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in want)
        assert (g["n_runs"], g["runs_sha256"], g["collapsed_sha256"]) == (
            len(want), hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, want).encode()).hexdigest())
        assert (g["start"], g["length"], g["period"], g["exponent_milli"]) == (
            (*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
    assert sum(g["n_runs"] > 0 for g in got.values()) > 10


def test_odd_rows(spark, odd):
    out = pr.find_runs(odd, out_col="found")
    assert out.columns == [*odd.columns, "found"] and out.count() == odd.count()
    found = {r["doc_id"]: r["found"] for r in out.where("doc_id is not null").collect()}
    assert [opened(found[i]["runs"]) for i in range(10)] == [[]] * 7 + [[(0, 3000, 1)]] + [[]] * 2
    assert found[7]["collapsed"] == "word" and found[0]["n_words"] == found[1]["n_words"] == found[2]["n_words"] == 0
    with pytest.raises(ValueError):
        pr.find_runs(odd, out_col="LABEL")
    assert pr.report(odd).count() == odd.count()
    assert pr.report(odd.limit(0)).count() == 0
    cut = pr.collapse(odd)
    assert cut.columns == odd.columns
    left = {r["doc_id"]: r["text"] for r in cut.where("doc_id is not null").collect()}
    assert left[7] == "word" and left[0] is None and left[2] == "   \n\t "


def test_long_and_hot_texts(spark):
    line = " ".join(f"w{i}" for i in range(500))
    long = pr.periodic(pa.array([" ".join([line] * 400), "a " * 1_000_000, line])).to_pylist()
    assert opened(long[0]["runs"]) == [(0, 200_000, 500)] and long[0]["collapsed"] == line
    assert opened(long[1]["runs"]) == [(0, 1_000_000, 1)] and long[1]["collapsed"] == "a"
    assert long[2]["runs"] == []
    docs = spark.range(0, 3000, 1, 7).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.repeat(F.lit("x y "), 40))
                                             .otherwise(F.concat(F.lit("x y "), F.col("id"))).alias("text"))
    got = pr.find_runs(docs).groupBy(F.size("periodic.runs").alias("n"), "periodic.n_words").count().collect()
    assert sorted(map(tuple, got)) == [(0, 3, 2000), (1, 80, 1000)]
