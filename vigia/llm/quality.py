"""Quality classifier: random Fourier features, ridge regression, isotonic
calibration.

1. Statistics of a whole text (:func:`statistics`): counts of characters,
   words and lines, repetition, symbols, entropy.
2. Random Fourier features of the standardised statistics approximate a
   Gaussian kernel.
3. Ridge regression on them: tasks sum their rows' normal equations, the sums
   are added up in a groupBy, and only the (features + 1) squared sums of each
   fold reach the driver, whatever the number of rows.
4. Isotonic calibration (pool adjacent violators) of out-of-fold scores, over
   counts of ``BINS`` score bins.

Labels enter only at 2-4, from rows outside the held-out share.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import attach, drop_stage, stage

FEATURES, GAMMA, RIDGE, FOLDS, BINS, CLIP = 192, 0.03, 1.0, 4, 1000, 5.0
THRESHOLD = 0.3
_PUNCTUATION = b".,;:'\"?-()"
_ENDS = (".", "!", "?", ":", ";", '"', "'", ")")


def statistics(text: str | None) -> list[float]:
    """Statistics of a whole text; null: as the empty text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256).astype(np.float64)
    size = max(1, n)
    upper, lower, digit = count[65:91].sum(), count[97:123].sum(), count[48:58].sum()
    space = count[9:14].sum() + count[32]
    high = count[128:].sum()
    marks = float(sum(count[b] for b in _PUNCTUATION))
    symbols = size - upper - lower - digit - space - high - marks if n else 0.0
    words = text.split()
    n_words = max(1, len(words))
    lines = [line for line in text.split("\n") if line]
    n_lines = max(1, len(lines))
    share = count[count > 0] / size
    letters = max(1.0, upper + lower + high)
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), size / n_words, n_words / n_lines,
        upper / letters, digit / size, space / size, high / size, marks / size, symbols / size,
        float(count[33]) / n_words, float(count[46]) / n_words, float(count[44]) / n_words,
        float(count[124] + count[95] + count[61] + count[60] + count[62]) / n_words,
        len(set(words)) / n_words, np.log1p(len(set(words))) / np.log1p(n_words),
        sum(map(eq, words, words[1:])) / n_words, len(set(lines)) / n_lines,
        sum(line.endswith(_ENDS) for line in lines) / n_lines,
        -float((share * np.log2(share)).sum()) if n else 0.0,
        len(zlib.compress(raw, 1)) / size if n else 1.0,
        len(re.findall(r"https?://|www\.|@", text)) / n_words,
        sum(map(str.istitle, words)) / n_words, max(map(len, words), default=0) / (n_words + 20.0),
    ]


N_STATISTICS = len(statistics(""))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # statistics x features
    phase: np.ndarray
    ridge: np.ndarray  # features + 1
    edges: np.ndarray  # calibrated steps: score -> share of label 1
    values: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -CLIP, CLIP)
        f = np.cos(z @ self.weights + self.phase) * np.sqrt(2.0 / len(self.phase))
        return np.hstack([f, np.ones((len(rows), 1))])

    def raw(self, rows: np.ndarray, ridge: np.ndarray | None = None) -> np.ndarray:
        return self.features(rows) @ (self.ridge if ridge is None else ridge)

    def scores(self, rows: list[list[float]]) -> pa.Array:
        x = np.array(rows, dtype=np.float64).reshape(len(rows), N_STATISTICS)
        return pa.array(np.clip(self.calibrated(self.raw(x)), 0, 1), type=pa.float64())

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.edges):
            return np.full(len(raw), 0.5)
        return np.interp(raw, self.edges, self.values)


def pool_adjacent(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic fit of the mean of y (weights n) against increasing x."""
    blocks: list[list[float]] = []  # sum x, sum y, weight, first x, last x
    for a, b, w in zip(x, y, n, strict=True):
        blocks.append([b * w, w, a, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w2, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w2
            blocks[-1][3] = last
    at = np.array([v for b in blocks for v in (b[2], b[3])])
    mean = np.array([b[0] / b[1] for b in blocks for _ in range(2)])
    return at, mean


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 5 == 0, F.lit(False))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.array(batch.column(name).to_pylist(), dtype=np.float64).reshape(batch.num_rows, -1)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every row's text, computed once and
    staged; texts are never shuffled."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return stage(attach(rows, "text", "x", "array<double>", lambda: lambda ts: [statistics(t) for t in ts])
                 .drop("text"), "statistics")


def fit(measured: DataFrame, labels: DataFrame, label_id: str = "doc_id", label_col: str = "quality",
        features: int = FEATURES, gamma: float = GAMMA, ridge: float = RIDGE, seed: int = 42) -> Model:
    """Fit on all labelled documents (rows of :func:`measure`) outside the
    held-out share (crc32 of the id mod 5 is 0).  Repeated labels of a document
    count once each, null labels and labels of absent documents not at all.
    Without any label 1 or any label 0 the model is constant (that label's
    share; 0.5 without labels)."""
    known = (labels.where(F.col(f"`{label_col}`").isNotNull() & ~held_out(label_id))
             .select(F.col(f"`{label_id}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("y")))
    train = stage(measured.join(known, F.col("doc_id") == F.col("id"))
                  .select("x", "y", (F.crc32(F.col("id").cast("string")) % 5 - 1).alias("fold")), "quality_train")
    try:
        return _fit(train, features, gamma, ridge, seed)
    finally:
        drop_stage(train)


def _fit(train: DataFrame, features: int, gamma: float, ridge: float, seed: int) -> Model:
    sums = train.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"),
                     *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(N_STATISTICS)],
                     *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(N_STATISTICS)]).first()
    random = np.random.default_rng(seed)
    mean = np.array([sums[f"m{i}"] or 0.0 for i in range(N_STATISTICS)])
    scale = np.array([sums[f"s{i}"] or 0.0 for i in range(N_STATISTICS)])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0),
                  random.normal(0, np.sqrt(2 * gamma), (N_STATISTICS, features)),
                  random.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.zeros(0), np.zeros(0))
    if not sums["n"] or sums["y"] in (0.0, 1.0):
        if sums["n"]:
            model.edges, model.values = np.zeros(1), np.array([sums["y"]])
        return model
    d = features + 1
    share = float(sums["y"])

    def normal_equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, d, d + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                z, y = model.features(_matrix(part, "x")), _matrix(part, "y")[:, 0]
                fold = _matrix(part, "fold")[:, 0].astype(int)
                for f in np.unique(fold):
                    own = fold == f
                    total[f, :, :d] += z[own].T @ z[own]
                    total[f, :, d] += z[own].T @ y[own]
        fold, row = np.divmod(np.arange(FOLDS * d), d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(fold, pa.int32()), pa.array(row, pa.int32()),
             pa.array(list(total.reshape(FOLDS * d, d + 1)), pa.list_(pa.float64()))], names=["fold", "row", "sums"])

    parts = train.mapInArrow(normal_equations, "fold int, row int, sums array<double>")
    added = (parts.select("fold", "row", F.posexplode("sums").alias("column", "value"))
             .groupBy("fold", "row", "column").agg(F.sum("value").alias("value"))
             .groupBy("fold", "row").agg(F.sort_array(F.collect_list(F.struct("column", "value"))).alias("sums"))
             .select("fold", "row", F.col("sums.value").alias("sums")))
    total = np.zeros((FOLDS, d, d + 1))
    for r in added.collect():  # bounded: folds x features rows
        total[r["fold"], r["row"]] = r["sums"]

    def solve(s: np.ndarray) -> np.ndarray:
        penalty = ridge * np.eye(d)
        penalty[-1, -1] = 1e-6
        return np.linalg.solve(s[:, :d] + penalty, s[:, d])

    whole = total.sum(axis=0)
    model.ridge = solve(whole)
    others = [solve(whole - total[f]) for f in range(FOLDS)]

    def score_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = np.zeros((BINS, 2))
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x, y = _matrix(part, "x"), _matrix(part, "y")[:, 0]
                fold = _matrix(part, "fold")[:, 0].astype(int)
                z = model.features(x)
                raw = np.einsum("ij,ij->i", z, np.array(others)[fold])
                bin_ = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
                np.add.at(tally, bin_, np.stack([np.ones(len(y)), y], axis=1))
        at = np.flatnonzero(tally[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(tally[at, 0], pa.float64()),
                                          pa.array(tally[at, 1], pa.float64())], names=["bin", "n", "ones"])

    bins = sorted((r["bin"], r["n"], r["ones"]) for r in
                  train.mapInArrow(score_bins, "bin int, n double, ones double").groupBy("bin")
                  .agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).collect())  # bounded: BINS rows
    x = np.array([(b + 0.5) / BINS * 2 - 0.5 for b, _, _ in bins])
    n = np.array([b[1] for b in bins])
    # a pseudo-count at the labels' share keeps the few rows of an end bin from certainty
    y = (np.array([b[2] for b in bins]) + 0.01 * share) / (n + 0.01)
    model.edges, model.values = pool_adjacent(x, y, n)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "quality_score") -> DataFrame:
    """``docs`` with ``out_col`` double, 0 to 1; null texts score as empty
    ones.  Each row by itself: repeated rows, ties and empty tables need
    nothing special; other columns pass through, a clashing name raises."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    return attach(docs, text_col, out_col, "double",
                  lambda: lambda ts: shared.value.scores([statistics(t) for t in ts]), rows=1024)


def predictions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_id: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    measured = measure(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(fit(measured, labels, label_id, label_col))
    scored = attach(measured, "x", "score", "double", lambda: lambda xs: shared.value.scores(xs), rows=1024)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
