import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from vigia.llm import packing
from vigia.llm.queries import op9_packing

from .conftest import SMALL

VOCABULARY = P.path("byte_bpe_50k.json")


def plain_best_fit(items, capacity):
    rooms = []
    for w in sorted(items, reverse=True):
        fits = [r for r in rooms if r >= w]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - w)
        else:
            rooms.append(capacity - w)
    return len(rooms)


def fewest(items, capacity):
    best = len(items)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for r in {r for r in rooms if r >= items[i]}:
            rest = list(rooms)
            rest.remove(r)
            go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*rooms, capacity - items[i]])

    items = sorted(items, reverse=True)
    go(0, [])
    return best


def test_plan_holds_every_piece_and_is_best_fit():
    random.seed(3)
    for _ in range(150):
        capacity = random.choice([20, 100, 1024])
        items = [random.randint(1, capacity) for _ in range(random.randint(1, 120))]
        counts = Counter(items)
        bins = packing.plan(dict(counts), capacity)
        held = Counter()
        for times, lengths in bins:
            assert times > 0 and sum(lengths) <= capacity
            for w in lengths:
                held[w] += times
        assert held == counts
        assert sum(t for t, _ in packing.best_fit(dict(counts), capacity)) == plain_best_fit(items, capacity)
        assert sum(t for t, _ in bins) <= plain_best_fit(items, capacity)


def test_reduction_never_costs_a_bin():
    random.seed(4)
    for _ in range(80):
        items = [random.randint(1, 10) for _ in range(random.randint(1, 8))]
        fixed, left = packing.reduce(dict(Counter(items)), 10)
        rest = [w for w, n in left.items() for _ in range(n)]
        assert sum(t for t, _ in fixed) + (fewest(rest, 10) if rest else 0) == fewest(items, 10)


def test_ids_are_the_library_ids(spark):
    whole, encode = Tokenizer.from_file(VOCABULARY), packing.vocabulary_encoder(VOCABULARY)
    random.seed(5)
    parts = ["a", "th", "the ", " ", "é", "1", "\n", "  ", "!!", "😀", "\t", "ing", "'s", " ", "<|endoftext|>", "\u0085"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 50))) for _ in range(1500)]
    texts += [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    for t in texts:
        assert encode(t).tolist() == whole.encode(t, add_special_tokens=False).ids


def check(rows, texts, copies=1):
    whole = Tokenizer.from_file(VOCABULARY)
    parts = {}
    for r in rows:
        parts.setdefault(r.doc_id, []).append(r)
    assert set(parts) == set(texts)
    for d, own in parts.items():
        ids = np.array([*whole.encode(texts[d] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        assert sum(r.length for r in own) == len(ids) * copies
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            assert r.length == 1024 if r.piece else r.length == (len(ids) % 1024 or 1024)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences)


def test_query_packs_all_documents(spark, docs):
    rows = op9_packing(spark, SMALL).collect()
    n = check(rows, {r.doc_id: r.text for r in docs.collect()})
    assert n <= 1.03 * math.ceil(sum(r.length for r in rows) / 1024)


def test_odd_rows(spark, odd):
    named = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check(packing.pack(named, VOCABULARY).collect(), {r.doc_id: r.text for r in named.collect()})
    assert packing.pack(odd, VOCABULARY).where("piece = 0").count() == odd.count()
    assert packing.pack(odd.limit(0), VOCABULARY).count() == 0
    kept = packing.pack(named, VOCABULARY, keep_ids=True).collect()
    assert all(len(r.ids) == r.length for r in kept)


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)]
