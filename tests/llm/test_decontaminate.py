"""Benchmark decontamination against a plain search of all windows."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigia.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(texts, items, window=10):
    """What the operator finds, by looking at every window."""
    owners = {}
    for name, text in items:
        w = split(text)
        for i in range(len(w) - min(window, len(w)) + 1 if w else 0):
            owners.setdefault(tuple(w[i:i + window]), set()).add(name)
    out = []
    for text in texts:
        w, hit, named = split(text), set(), set()
        for size in {len(k) for k in owners}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in owners:
                    hit |= set(range(i, i + size))
                    named |= owners[tuple(w[i:i + size])]
        out.append((len(w), sorted(hit), sorted(n for n in named if n is not None)))
    return out


def opened(found):
    return [(f["n_words"], [i for s in f["spans"] for i in range(s["start"], s["end"])], list(f["items"])) for f in found]


@pytest.mark.parametrize("seed", range(6))
def test_random_texts(seed):
    rng = np.random.default_rng(seed)
    draw = lambda n, k: " ".join(f"w{i}" for i in rng.integers(0, k, n))
    items = [(str(i), draw(n, 4)) for i, n in enumerate(rng.integers(1, 30, 12))] + [("none", ""), ("null", None)]
    whole = [t for _, t in items if t]
    texts = [draw(int(n), int(k)) for n, k in zip(rng.integers(0, 400, 30), rng.integers(2, 6, 30), strict=True)]
    texts += [f"{draw(9, 9)} {t.upper()}, {t}" for t in whole] + [None, "", "w1 w1"]
    window = [10, 3, 7][seed % 3]
    phrases = dc.Phrases([(i, t and t.encode()) for i, t in items], window)
    got = dc.search([t and t.encode() for t in texts], phrases, size=[1 << 19, 50, 300][seed % 3], block=[256, 8, 30][seed % 3])
    assert opened(got) == plain(texts, items, window)
    assert all(a["end"] < b["start"] for f in got for a, b in zip(f["spans"], f["spans"][1:], strict=False))


def test_index_counts_and_places():
    rng = np.random.default_rng(5)
    blocks = [rng.integers(1, 4, n) for n in (40, 1, 7, 40, 40)]
    blocks[3] = blocks[0]  # equal blocks differ by their end signs only
    text = np.concatenate([np.append(b, 0) for b in blocks])
    index = dc.FMIndex(text, 5, sample=4)
    assert sorted(index.locate(np.arange(len(text))).tolist()) == list(range(len(text)))
    for phrase in ([1], [2, 3], [1, 1, 2], [4], [3, 4], blocks[0].tolist()):
        lo, hi = index.search(np.array([phrase]))
        want = [i for i in range(len(text)) if text[i:i + len(phrase)].tolist() == phrase]
        assert sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) == want


def test_queries_whole_table(spark, docs):
    from .conftest import SMALL
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = plain([r["text"] for r in rows], [(str(r["item_id"]), r["text"]) for r in bench.collect()])
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in dc.report(docs, bench).collect()}
    assert got == {r["doc_id"]: (n, len(h), len(i), bool(h)) for r, (n, h, i) in zip(rows, want, strict=True)}
    assert 0 < sum(g[3] for g in got.values()) < len(got)


def test_blocks_of_items_and_odd_rows(spark, odd):
    items = spark.createDataFrame([("b", "same text here", 1), ("a", "word word word", 2), (None, "cödé", 3), ("e", "", 4),
                                   ("n", None, 5), ("b", "same text here", 6)], "item_id string, text string, spans int")
    texts = [r["text"] for r in odd.collect()]
    want = plain(texts, [(r["item_id"], r["text"]) for r in items.collect()])
    for size in (1 << 20, 20):
        out = dc.contamination(odd, items, item_bytes=size)
        assert out.columns == [*odd.columns, "contamination"]
        got = {(r["doc_id"], r["text"]): r["contamination"] for r in out.collect()}
        keys = [(r["doc_id"], r["text"]) for r in odd.collect()]
        assert opened([got[k] for k in keys]) == want
        assert out.count() == odd.count()
    cut = dc.remove(odd, items)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    left = {r["doc_id"]: r["text"] for r in cut.where("doc_id is not null").collect()}
    assert left[5] == "" and left[0] is None and left[4] == "Ünï  ß 漢字 😀" and left[7].strip() == ""
    with pytest.raises(ValueError):
        dc.contamination(odd, items, out_col="LABEL")


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert dc.report(docs, items).where("contaminated or n_hit > 0 or n_items > 0").count() == 0
    assert dc.report(docs.limit(0), items).count() == 0


def test_a_passage_in_a_third_of_the_documents(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = spark.range(0, 3000, 1, 7).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 3 == 0, F.concat(F.lit("x "), F.repeat(F.lit(passage + " "), 5))).otherwise("p1 p2 y").alias("text"))
    items = spark.createDataFrame([(1, passage), (2, "other words")], "item_id int, text string")
    got = dc.report(docs, items).groupBy("contaminated", "n_hit", "n_items").count().collect()
    assert sorted(map(tuple, got)) == [(False, 0, 0, 2000), (True, 60, 1, 1000)]


def test_one_very_long_text(spark):
    rng = np.random.default_rng(1)
    words = [f"a{i}" for i in rng.integers(0, 50, 300_000)]
    items = [(str(k), " ".join(words[at:at + 25])) for k, at in enumerate((0, 1000, 299_975))]
    phrases = dc.Phrases([(i, t.encode()) for i, t in items], 10)
    got = dc.search([" ".join(words).encode()], phrases, size=40_000)[0]
    assert [(s["start"], s["end"]) for s in got["spans"]] == [(0, 25), (1000, 1025), (299_975, 300_000)]
    assert got["items"] == ["0", "1", "2"]
