import hashlib

from pyspark.sql import functions as F

from vigia.llm import order_minhash as om
from vigia.llm.queries import op8_order_minhash

from .conftest import SMALL


def test_query_edits_and_likeness(spark, docs):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(texts, reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    got = op8_order_minhash(spark, SMALL).collect()
    assert len(got) == len(texts)
    prints = {r.doc_id: r.fingerprint for r in got}
    for r in got:
        t, k = texts[r.doc_id], len(texts[r.doc_id]) // 3
        edited = t[:len(t) - k] + texts[after[r.doc_id]][:k]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_next == 1) == (prints[r.doc_id] == prints[after[r.doc_id]])
        if k > 150:
            assert r.near_edited > 0.4
    long = [r for r in got if r.n_chars > 500]
    assert sum(r.near_edited for r in long) / len(long) > 0.6 > 0.1 > sum(r.near_next for r in long) / len(long)


def words(text):
    return [w[i:i + om.PIECE] for w in text.split() for i in range(0, len(w), om.PIECE)]


def test_slots_equal_brute_force(spark):
    """Minima, numbering and order recomputed row by row from Spark's hashes."""
    texts = ["a b c d e f g", "a b c a b c a b c a b c", " ".join(f"w{i % 50}" for i in range(900)), "x y", "one", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.slots for r in om.with_slots(df, "text").collect()}

    def sign(v):
        return (v + 2**63) % 2**64 - 2**63

    def xx(schema, rows):
        return [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i long, {schema}")
                .coalesce(1).sortWithinPartitions("i")
                .select(F.xxhash64(*[c.split()[0] for c in schema.split(", ")])).collect()]

    for i, text in enumerate(texts):
        w = words(text)
        if len(w) >= om.K:
            kmers = xx("a string, b string, c string", list(zip(w, w[1:], w[2:], strict=False)))
        else:
            kmers = xx("a array<string>", [(w,)]) if w else []
        if not kmers:
            assert got[i] == [None] * om.SLOTS
            continue
        seen, numbered = {}, []
        for h in kmers:
            h >>= om.PLACE
            numbered.append((h, seen.get(h, 0)))
            seen[h] = seen.get(h, 0) + 1
        labels = [(h >> om.PLACE, at) for at, h in enumerate(xx("a long, b int", numbered))]
        slots = {}
        for h, at in sorted(labels):
            slots.setdefault((h >> (64 - om.PLACE - 6)) + om.SLOTS // 2, []).append((at, h))
        want = [None] * om.SLOTS
        keys = sorted(slots)
        pairs = [tuple(h for _, h in sorted(slots[s][:2])) for s in keys]
        for n in (1, 2):
            chosen = [(s, p) for s, p in zip(keys, pairs, strict=True) if len(p) == n]
            if chosen:
                hashes = xx(", ".join(f"{c} long" for c in "ab"[:n]), [p for _, p in chosen])
                for (s, _), h in zip(chosen, hashes, strict=True):
                    want[s] = sign(h) >> 32
        assert got[i] == want, text


def test_order_matters_and_equal_texts_agree(spark):
    a = [f"w{i}" for i in range(400)]
    moved = a[200:] + a[:200]
    df = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(a)), (3, " ".join(moved))], "doc_id long, text string")
    p = {r.doc_id: r for r in om.with_slots(df, "text").collect()}
    assert p[1].slots == p[2].slots
    alike = sum(x == y for x, y in zip(p[1].slots, p[3].slots, strict=True)) / om.SLOTS
    assert 0.3 < alike < 0.9  # nearly the same k-mers, but half of the pairs turned round


def test_odd_rows(spark, odd):
    got = om.edited_fingerprints(odd).collect()
    assert len(got) == odd.count()
    one = om.edited_fingerprints(odd.where("doc_id = 4")).first()
    assert one.near_next == 1  # its own next
    assert om.edited_fingerprints(odd.where("doc_id is null")).count() == 1
    assert om.edited_fingerprints(odd.limit(0)).count() == 0
    none = [r for r in got if r.doc_id in (0, 1, 2)]
    assert len({r.fingerprint for r in none}) == 1


def test_no_python_on_the_executors(docs):
    plan = om.edited_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
