import numpy as np

from vigia.llm import embeddings
from vigia.llm.queries import op6_embeddings

from .conftest import SMALL


def plain(ids, x):
    norm = np.linalg.norm(x, axis=1)
    near = (x @ x.T) / np.outer(norm, norm) >= 0.9
    np.fill_diagonal(near, False)
    names = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            least = min([names[i], *(names[j] for j in np.flatnonzero(near[i]))])
            changed |= least != names[i]
            names[i] = least
    return {i: (int(n), c) for i, n, c in zip(ids, near.sum(axis=1), names, strict=True)}


def clusters():
    rng = np.random.default_rng(1)
    rows = [c + rng.normal(size=32) * rng.uniform(0.05, 0.45)
            for c in rng.normal(size=(120, 32)) for _ in range(rng.integers(1, 25))]
    rows = np.vstack([rows, rows[:30], np.array(rows[:20]) * 2])  # copies, and the same directions
    return list(range(len(rows))), rows


def test_links_and_components_equal_brute_force(spark):
    ids, x = clusters()
    want = plain(ids, x)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    # one bucket; many buckets with lists that must be enlarged
    for bucket, neighbours in ((4096, 12), (32, 5)):
        got = embeddings.near_duplicates(df, bucket=bucket, neighbours=neighbours, block=64).collect()
        links = sum(r.n_links for r in got)
        assert links >= 0.99 * sum(n for n, _ in want.values())
        assert all(r.n_links <= want[r.vec_id][0] for r in got)
        if bucket == 4096:
            assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    want = plain([r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=np.float64))
    assert {r.vec_id: (r.n_links, r.component_id) for r in op6_embeddings(spark, SMALL).collect()} == want


def test_odd_vectors(spark):
    odd = spark.createDataFrame(
        [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0], 0), (6, [float("nan"), 1.0], 0),
         (7, [None, 1.0], 0), (None, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (8, [1.0, 0.0, 0.0], 0), (9, [1.0, 0.1], 0),
         (10, [float("inf"), 0.0], 0)], "vec_id long, embedding array<double>, weight int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(odd).collect())
    assert got == [(0, 0, None, False), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (3, 0, 3, True),
                   (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True),
                   (9, 3, 1, False), (10, 0, 10, True)]
    assert embeddings.near_duplicates(odd.limit(0)).count() == 0


def test_tables_grow_with_the_bits():
    assert embeddings.meeting_tables(0, 0.9, 0.99) == 1
    assert embeddings.meeting_tables(8, 0.9, 0.99) > embeddings.meeting_tables(5, 0.9, 0.99) > 1


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def test_saturated_groups_are_joined(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=32)
    a /= np.linalg.norm(a)
    b = rng.normal(size=32)
    b -= (a @ b) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b)
    x = np.vstack([c + rng.normal(size=(100, 32)) * 0.015 for c in (a, b)])
    want = plain(range(len(x)), x)
    assert {n for n, _ in want.values()} == {199} and {c for _, c in want.values()} == {0}
    for bucket in (4096, 64):  # one bucket; some
        got = embeddings.near_duplicates(frame(spark, x), bucket=bucket, block=64).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


def cone():
    """One narrow cone whose vectors mostly don't link, and pairs that do."""
    rng = np.random.default_rng(3)
    axis = np.zeros(32)
    axis[0] = 1.0
    x = axis * 1.5 + rng.normal(size=(1500, 32)) * 0.2
    return np.vstack([x, x[:150] + rng.normal(size=(150, 32)) * 0.06])


def test_hot_buckets_keep_their_links(spark):
    x = cone()
    want = plain(range(len(x)), x)
    got = embeddings.near_duplicates(frame(spark, x), bucket=16).collect()
    assert sum(r.n_links for r in got) >= 0.98 * sum(n for n, _ in want.values())
    assert all(r.n_links <= want[r.vec_id][0] for r in got)


def test_what_the_audit_rejects_is_finished_by_blocks(spark):
    x = cone()[1200:]
    want = plain(range(len(x)), x)
    got = embeddings.near_duplicates(frame(spark, x), bucket=8, neighbours=2, meet=0.05, recall=1.01, block=64).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


def test_very_large_and_very_small_vectors_link_by_direction(spark):
    a, b = np.array([1.0, 2.0, -0.5]), np.array([-2.0, 1.0, 3.0])
    sizes = [1e200, 1e-170, 1e308 / 4, 5e-320, 1e-308, 1.0, 1e100, 1e-100]
    rows = [(i, (v * s).tolist()) for i, (v, s) in enumerate((v, s) for v in (a, b) for s in sizes)]
    rows += [(100, [0.0, 0.0, 0.0]), (101, [float("inf"), 1.0, 0.0]), (102, [5e-324, 0.0, 0.0]), (103, [1e308, 0.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    for i in range(8):
        assert got[i] == (7, 0, i == 0) and got[8 + i] == (7, 8, i == 0)
    assert got[100] == (0, 100, True) and got[101] == (0, 101, True)
    assert got[102] == (1, 102, True) and got[103] == (1, 102, False)
