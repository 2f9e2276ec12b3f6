"""Hard negatives against scoring every row."""

import numpy as np
import pytest

from vigia.llm import hard_negatives as hn


def plain(rows, every=1, positives=5, negatives=3, band=(50, 95)):
    """rows: {id: (label, vector)}."""
    d = max((len(v) for _, v in rows.values()), default=0)
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b, strict=False))
    out = []
    for a in sorted(rows):
        if a % every:
            continue
        label, x = rows[a]
        scored = sorted((-dot(x, v), i, other) for i, (other, v) in rows.items() if i != a)
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            fit = [r for r in scored if r[2] != label and band[0] * -s <= 100 * -r[0] <= band[1] * -s][:negatives]
            out += [(a, p, k, i, -s, -t) for k, (t, i, _) in enumerate(fit, 1)]
    assert d >= 0
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, label, [int(c) for c in v]) for i, (label, v) in rows.items()],
                                 "vec_id long, label int, vec array<long>").repartition(5)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(df, every=1, **options):
    out = hn.mine(df, lambda i: i % every == 0, **options)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_clustered_vectors(spark, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(6, 8)) * 40
    rows = {i: (int(rng.integers(0, 3)), np.floor(middle[i % 6] + rng.normal(size=8) * [4, 15, 60][seed])) for i in range(400)}
    got = mined(frame(spark, rows), 4, cluster=[10, 25, 1000][seed], proof=[50, 0, 400][seed], parts=[1, 3, 2][seed])
    assert got == plain(rows, 4) and got


def test_walks_end_early(spark):
    """Members stop, with proof, long before the list of a far cluster ends."""
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(200, 8)) + 30 * np.eye(8)[g] for g in range(4)]) * 100
    x = np.floor(x).astype(np.int64)
    shape = hn.Shape(8, int(np.abs(x).max()))
    at = hn.centroids(x[:200], 1)
    radius = hn.angles(x[:200], at).max()
    bounds = hn.norms(x) * np.cos(np.maximum(0, hn.angles(x, at)[:, 0] - radius))
    order = np.argsort(-bounds)
    low = [[hn.LEAST]] * 200
    walk = hn.Walk(shape, np.arange(200), np.zeros(200, np.int64), x[:200], low, [[1 << 62]] * 200, low, True, 5)
    steps = 0
    for i in range(0, 800, 50):
        at = order[i:i + 50]
        if not walk.step(bounds[at[0]], at, np.zeros(50, np.int64), x[at]):
            break
        steps += 1
    assert steps <= 5
    m, _, ids, score = walk.found()
    exact = x[:200] @ x.T
    exact[np.arange(200), np.arange(200)] = np.iinfo(np.int64).min
    assert (np.sort(score.reshape(200, 5), axis=1) == np.sort(exact, axis=1)[:, -5:]).all()


def test_ties_zeros_and_one_label(spark):
    rows = {i: (i % 2, [0, 0, 0]) for i in range(12)} | {i: (i % 2, [10, 0, 0]) for i in range(12, 30)} | {
        40: (7, [5, 5, 5]), 50: (1, [9, 0, 0]), 51: (0, [7]), 52: (1, []), 53: (0, [-10, 1, 0])}
    assert mined(frame(spark, rows)) == plain(rows)
    same = {i: (1, v) for i, (_, v) in rows.items()}
    assert mined(frame(spark, same)) == []


def test_large_numbers_are_exact(spark):
    rows = {i: (i % 2, [2**30 + i, 3 - i, 2**29 - 7 * i]) for i in range(40)}
    wide = {i: (k, [c * (4 if k else 5) // 5 for c in v]) for i, (k, v) in rows.items()}
    assert mined(frame(spark, wide), 2) == plain(wide, 2) != []
    with pytest.raises(Exception, match="64 bits"):
        mined(frame(spark, {i: (i % 2, [2**40]) for i in range(20)}))


def test_odd_rows(spark):
    vec, nan, inf = [0.5, 0.25], float("nan"), float("inf")
    rows = [(0, 1, vec, "a"), (50, 1, vec, "b"), (51, 1, [0.5, 0.2], "c"), (52, 2, [0.4, 0.2], None), (53, 2, [0.3, 0.3], "x"),
            (52, 2, [0.4, 0.2], None), (54, None, vec, "n"), (55, 2, None, "n"), (57, 2, [nan, 0.4], "n"), (58, 2, [inf, 0.4], "n"),
            (59, 2, [None, 0.4], "n"), (None, 2, [0.4, 0.2], "n"), (60, 2, [], "e"), (63, 0, [0.5, 0.1], "moved to 1")]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, anchor_id string")
    scaled = lambda v: [int(np.floor(256 * float(np.float32(c)))) for c in v]
    good = {r[0]: ((r[1] + 1) % 10 if r[0] % 7 == 0 else r[1], scaled(r[2])) for r in rows
            if r[0] is not None and r[1] is not None and r[2] is not None and all(c is not None and np.isfinite(c) for c in r[2])}
    assert sorted(map(tuple, hn.report(df).collect())) == plain(good, 50) != []
    assert hn.report(df.limit(0)).count() == 0


def test_hot_vector_and_label(spark):
    """A third of the rows are one vector of one label."""
    rng = np.random.default_rng(2)
    rows = {i: (0, [100, 50, 0, 0]) if i % 3 == 0 else (int(rng.integers(1, 4)), np.floor(rng.normal(size=4) * 80))
            for i in range(900)}
    assert mined(frame(spark, rows), 10, parts=4) == plain(rows, 10)
