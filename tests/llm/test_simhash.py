import random
import re

import numpy as np
import xxhash

from vigia.llm import simhash
from vigia.llm.components import connected_components
from vigia.llm.queries import op2_simhash

from .conftest import SMALL


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, names, radius=2):
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    f = np.array(prints, dtype=np.uint64)
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= radius) + i + 1:
            a, b = sorted((root(i), root(int(j))))
            up[b] = a
    groups = {}
    for i in range(len(f)):
        groups.setdefault(root(i), []).append(names[i])
    return {n: min(g) for g in groups.values() for n in g}


def test_query_equals_brute_force(spark, docs):
    rows = docs.collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    want = plain_components(prints, [r.doc_id for r in rows])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op2_simhash(spark, SMALL).collect()}
    assert got == {r.doc_id: (f"{p:016x}", want[r.doc_id]) for r, p in zip(rows, prints, strict=True)}


def test_hot_keys_in_many_units_find_every_component(spark):
    random.seed(1)
    values = set()
    for _ in range(20):
        x = random.getrandbits(64)
        for _ in range(40):
            for _ in range(random.randint(1, 3)):
                x ^= 1 << random.randrange(64)
            values.add(x)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    want = plain_components(values, signed)
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    for shard in (512, 7):  # on both sides of the split
        roots = {r.node: r.root for r in connected_components(simhash.link_forest(nodes, 2, shard)).collect()}
        groups, same = {}, {}
        for v in signed:
            groups.setdefault(roots.get(v, v), set()).add(v)
            same.setdefault(want[v], set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, same.values()))


def test_tree_finds_all_within_the_radius():
    random.seed(2)
    values = [random.getrandbits(10) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in range(0, 1024, 13):
        for r in (0, 1, 3):
            assert set(tree.within(q, r)) == {v for v in values if (v ^ q).bit_count() <= r}


def test_components_of_a_long_path(spark):
    roots = connected_components(spark.range(60).selectExpr("id a", "id + 1 b"))
    assert roots.count() == 61 and roots.select("root").distinct().count() == 1


def test_odd_rows(odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    empty = [r for r in got if r.doc_id in (0, 1, 2)]
    assert {r.fingerprint for r in empty} == {"0" * 16} and {r.component_id for r in empty} == {0}
    same = [r for r in got if r.doc_id in (5, 6, None)]
    assert len(same) == 4 and {r.component_id for r in same} == {5}
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
