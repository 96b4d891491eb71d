"""Operator 9: quality classifier, a linear SVM on naive-Bayes features.

A text's features are indicators of its byte trigrams (hashed) and of runs of
two, three and four equal words, each scaled by its log-count ratio between
the classes and by the root of their number. A hinge-loss linear model is fitted
to them by dual coordinate descent, and its margin is turned into a
probability by a logistic curve fitted to rows set aside for that.

The fit sees a bounded sample: at most ``MAX_PER_CLASS`` labelled rows of each
class that are in the corpus, those with the smallest hash of their id, gathered
in one task; the class sizes come from all labelled rows of the corpus. Scoring
reads every whole text and moves nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.llm.common import checkpoint, table, values

#: Bound of the sample that the model is fitted to, per class.
MAX_PER_CLASS = 4000
BITS = 18
RUNS = (2, 3, 4)
DIM = (1 << BITS) + len(RUNS)
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20
CUT = 0.3


class Indicators:
    """The distinct features of a text; keeps one flag a feature."""

    def __init__(self):
        self.seen = np.zeros(1 << BITS, dtype=bool)

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        b = np.frombuffer(text.encode(), dtype=np.uint8).astype(np.uint32)
        found = np.empty(0, np.int64)
        if len(b) >= 3:
            gram = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
            self.seen[(gram * np.uint32(2654435761)) >> np.uint32(32 - BITS)] = True
            found = np.flatnonzero(self.seen)
            self.seen[found] = False
        words = text.split()
        longest = run = 1
        for a, c in zip(words, words[1:]):
            if a == c:
                run += 1
                longest = max(longest, run)
            else:
                run = 1
        return np.append(found, [(1 << BITS) + i for i, n in enumerate(RUNS) if longest >= n]).astype(np.int64)


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    counts = np.full((2, DIM), SMOOTHING)
    for x, label in zip(rows, y):
        counts[int(label), x] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def coordinate_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, cost: float = COST) -> np.ndarray:
    """Weights (the last one of a constant feature) that minimise
    |w|^2 / 2 + cost * sum of hinge losses, by its dual, one row at a time."""
    w, alpha = np.zeros(DIM + 1), np.zeros(len(rows))
    sign = np.where(y > 0, 1.0, -1.0)
    values = [np.append(ratio[x] / np.sqrt(max(1, len(x))), 1.0) for x in rows]
    at = [np.append(x, DIM) for x in rows]
    norms = [float(v @ v) for v in values]
    rng = np.random.default_rng(9)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = sign[i] * float(w[at[i]] @ values[i]) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost)
            if new != alpha[i]:
                w[at[i]] += (new - alpha[i]) * sign[i] * values[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m, -500, 500)))


def calibrate(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, with smoothed targets."""
    ones, zeros = weight[y > 0].sum(), weight[y <= 0].sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * margin + b)
        d, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(d * margin).sum() + 1e-3 * a, d.sum()])
        hessian = np.array([[(h * margin * margin).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-9]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 0.0), float(b)


def fit(rows: list[np.ndarray], y: np.ndarray, sizes: tuple[int, int]) -> np.ndarray:
    """Weights per feature, of the constant, then slope and offset; sizes: of
    the classes 0 and 1 among all labelled rows. A fifth of each class's rows
    calibrate what the others teach; a class's only row does both. If a class
    has no row, there is nothing to tell apart: the score is the smoothed share
    of class 1."""
    out = np.zeros(DIM + 3)
    share = (sizes[1] + 1) / (sum(sizes) + 2)
    if not (y == 0).any() or not (y == 1).any():
        out[-2:] = 1.0, np.log(share / (1 - share))
        return out
    aside, learnt = np.zeros(len(y), bool), np.ones(len(y), bool)
    for label in (0, 1):
        of = np.flatnonzero(y == label)
        aside[of[::5]] = True
        learnt[of[::5]] = len(of) == 1
    train = [x for x, use in zip(rows, learnt) if use]
    ratio = log_count_ratio(train, y[learnt])
    w = coordinate_descent(train, ratio, y[learnt])
    out[:DIM], out[DIM] = w[:DIM] * ratio, w[DIM]
    taken = np.array([(y == 0).sum(), (y == 1).sum()])
    weight = (np.array(sizes) / taken)[y.astype(int)]
    margin = margins([x for x, a in zip(rows, aside) if a], out)
    out[-2:] = calibrate(margin, y[aside], weight[aside] / weight[aside].mean())
    return out


def margins(rows: list[np.ndarray], model: np.ndarray) -> np.ndarray:
    return np.array([model[x].sum() / np.sqrt(max(1, len(x))) for x in rows]) + model[DIM]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = MAX_PER_CLASS) -> np.ndarray:
    """The model, from labelled rows that are not held out. Of a document with
    several labels the largest counts; null labels and ids are passed over, and
    labels of no document; of rows that repeat an id the smallest text is learnt from."""
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    known = checkpoint(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picks = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    sample = docs.select("doc_id", "text").join(F.broadcast(picks[0].union(picks[1])), "doc_id")  # at most 2 * per_class ids
    sample = sample.groupBy("doc_id", "y").agg(F.min("text").alias("text"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in batches:
            found = [indicators(t) for t in values(batch, 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "y", "x"])

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            rows += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), [x.values.to_numpy() for x in batch.column(2)])
        rows.sort(key=lambda r: r[0])
        model = fit([r[2] for r in rows], np.array([r[1] for r in rows], dtype=float), (sizes.get(0, 0), sizes.get(1, 0)))
        yield pa.RecordBatch.from_arrays([pa.array([model.tolist()], pa.list_(pa.float64()))], names=["model"])

    features = sample.mapInArrow(featurise, f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, y int, x array<int>")
    found = features.repartition(1).mapInArrow(fit_all, "model array<double>").collect()
    return np.array(found[0]["model"]) if found else fit([], np.empty(0), (0, 0))


def score(docs: DataFrame, model: np.ndarray, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score. Null text is empty; an empty
    text has no features and gets the score of the constant alone."""
    at = docs.columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` double"
    slope, offset = model[-2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in batches:
            m = [model[x].sum() / np.sqrt(max(1, len(x))) + model[DIM] for x in map(indicators, values(batch, at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(slope * np.array(m) + offset))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``. A null id
    is not held out; repeated rows are scored alike; further columns are not
    looked at; without labels every score is 0.5, with labels of one class the
    smoothed share of class 1; an empty table gives no rows."""
    texts = docs.select("doc_id", "text")
    scored = score(texts, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, corpus: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted to be of class 1, with all their columns;
    learnt from ``corpus``, which also has what earlier stages removed. Null and
    empty texts are scored by the constant alone; repeated rows are scored alike
    and all kept or not; further columns come back as they are; an empty table
    gives none."""
    return score(docs, train(corpus, labels), "__llm_score").where(F.col("__llm_score") >= CUT).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
