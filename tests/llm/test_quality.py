import zlib

import numpy as np

from vigia.llm import quality
from vigia.llm.queries import op7_quality

from .conftest import SMALL

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    got = op7_quality(spark, MEDIUM).collect()
    assert len(got) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) >= 0.93


def test_held_out_labels_are_not_learned(spark, docs):
    """Turning every held-out label round changes no score."""
    from pyspark.sql import functions as F
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
                                                 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality.predictions(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.predictions(docs, turned).collect()}
    assert a == b or max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_isotonic_fit_is_the_least_squares_one():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n = rng.integers(1, 9)
        y, w = rng.random(n), rng.integers(1, 5, n).astype(float)
        at, mean = quality.pool_adjacent(np.arange(n, dtype=float), y, w)
        got = np.interp(np.arange(n), at, mean)
        # the min-max formula of isotonic regression
        want = [max(min(np.average(y[i:j + 1], weights=w[i:j + 1]) for j in range(k, n)) for i in range(k + 1))
                for k in range(n)]
        assert np.allclose(got, want)


def test_no_or_one_sided_labels_give_a_constant(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.predictions(docs, none).collect()} == {0.5}
    ones = docs.selectExpr("doc_id", "1 quality").union(spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int"))
    assert {r.score for r in quality.predictions(docs, ones).collect()} == {1.0}


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    got = quality.predictions(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (0, 1)}) == 1  # null as empty
    assert quality.predictions(odd.limit(0), labels).count() == 0
