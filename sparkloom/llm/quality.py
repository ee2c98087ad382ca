"""Quality classifier: naive-Bayes support vectors (n-gram indicators scaled by class log-count ratios,
then a linear hinge-loss model fitted by dual coordinate descent).

Features of a text are indicators of hashed n-grams: words, word pairs, and n-grams (one to three) of
token shapes (lower, capitalised, upper case, digits, each kind of punctuation, a word said again).
Null and empty texts have no features; their score is the calibrated intercept. Labels, lang, source and
ids are never inputs.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import WordCache, fit_platt, in_parts, labelled_sample, map_batches, sigmoid, texts_of

BITS = 20
SIZE = 1 << BITS
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")

LOWER, CAPITAL, UPPER, DIGITS, AGAIN, EDGE, MARK = 1, 2, 3, 4, 5, 6, 16
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BITS)


def _describe(token: str) -> int:
    """Hash of the word in lower case and, in the low byte, its shape."""
    first = token[0]
    if first.isalpha():
        shape = UPPER if len(token) > 1 and token.isupper() else CAPITAL if first.isupper() else LOWER
    elif first.isdigit():
        shape = DIGITS
    else:
        shape = MARK + zlib.crc32(token[:2].encode()) % 200
    return zlib.crc32(token.lower().encode()) << 8 | shape


def _bucket(values: np.ndarray) -> np.ndarray:
    return ((values.astype(np.uint64) * _MIX) >> _SHIFT).astype(np.int64)


class Features:
    """Indices of a text's n-gram indicators, sorted, each once."""

    def __init__(self):
        self._cache = WordCache(_describe)

    def __call__(self, text: str) -> np.ndarray:
        tokens = TOKEN.findall(text)
        if not tokens:
            return np.empty(0, np.int64)
        found = np.fromiter(map(self._cache.__getitem__, tokens), np.int64, len(tokens))
        word, shape = found >> 8, found & 255
        again = (word[1:] == word[:-1]) & (shape[1:] < MARK)
        shape = np.concatenate(([EDGE], shape, [EDGE]))
        shape[2:-1][again] = AGAIN
        parts = (word, (word[:-1] << 31 ^ word[1:]) | 1 << 63 - 1, shape | 1 << 50,
                 shape[:-1] << 8 | shape[1:] | 1 << 51,
                 shape[:-2] << 16 | shape[1:-1] << 8 | shape[2:] | 1 << 52)
        return _bucket(np.unique(np.concatenate(parts)))


@dataclass
class QualityModel:
    weights: np.ndarray
    intercept: float
    scale: tuple[float, float]

    def margin(self, features: np.ndarray, norm: np.ndarray) -> float:
        if not len(features):
            return self.intercept
        return float(self.weights[features].sum() / np.sqrt(norm[features].sum() + 1e-12)) + self.intercept


def log_count_ratio(rows: list[np.ndarray], target: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """log of the smoothed shares of each indicator among the rows of class 1 and of class 0."""
    counts = [np.full(SIZE, smooth, np.float64) for _ in range(2)]
    for features, y in zip(rows, target):
        counts[int(y)][features] += 1.0
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], target: np.ndarray, ratio: np.ndarray, cost: float = 1.0,
                            epochs: int = 30, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and intercept of the L2-regularised hinge loss on rows of unit length.

    Each pass visits the rows in a seeded random order and solves its dual variable exactly, in
    [0, cost / class weight]; it stops when no projected gradient exceeds the tolerance.
    """
    sign = np.where(target > 0, 1.0, -1.0)
    weight, bias = np.zeros(SIZE), 0.0
    alpha = np.zeros(len(rows))
    share = np.array([max(1, (target == k).sum()) for k in (0, 1)]) / max(1, len(target))
    upper = np.where(target > 0, cost * 0.5 / share[1], cost * 0.5 / share[0])
    values = []
    for features in rows:
        x = ratio[features]
        length = np.sqrt((x * x).sum())
        values.append(x / length if length > 0 else x)
    draw = np.random.default_rng(7)
    for _ in range(epochs):
        largest = 0.0
        for i in draw.permutation(len(rows)):
            features, x = rows[i], values[i]
            gradient = sign[i] * (float(weight[features] @ x) + bias) - 1.0
            free = gradient
            if alpha[i] <= 0:
                free = min(gradient, 0.0)
            elif alpha[i] >= upper[i]:
                free = max(gradient, 0.0)
            largest = max(largest, abs(free))
            if free:
                old = alpha[i]
                alpha[i] = min(max(old - gradient / (float(x @ x) + 1.0), 0.0), upper[i])
                step = (alpha[i] - old) * sign[i]
                weight[features] += step * x
                bias += step
        if largest < tolerance:
            break
    return weight, bias


def fit(rows: list[np.ndarray], target: np.ndarray, cost: float = 1.0) -> QualityModel:
    """Train on all rows; calibrate on margins of rows left out, one half at a time."""
    ratio = log_count_ratio(rows, target)
    weight, bias = dual_coordinate_descent(rows, target, ratio, cost)
    margins = np.zeros(len(rows))
    half = np.random.default_rng(1).permutation(len(rows)) % 2
    for k in (0, 1):
        learn = np.flatnonzero(half != k)
        if len(set(target[learn])) < 2:
            continue
        sub_rows, sub_target = [rows[i] for i in learn], target[learn]
        sub_ratio = log_count_ratio(sub_rows, sub_target)
        w, b = dual_coordinate_descent(sub_rows, sub_target, sub_ratio, cost)
        sub = QualityModel((w * sub_ratio).astype(np.float32), b, (1.0, 0.0))
        for i in np.flatnonzero(half == k):
            margins[i] = sub.margin(rows[i], sub_ratio * sub_ratio)
    scale = fit_platt(margins, target) if len(set(target)) > 1 else (0.0, 4.0 if target.sum() else -4.0)
    return QualityModel((weight * ratio).astype(np.float32), bias, scale), (ratio * ratio).astype(np.float32)


def train_quality(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, per_class: int = 4000,
                  label: str = "quality") -> tuple[QualityModel, np.ndarray]:
    """Fit on at most `per_class` labelled rows of each class (the documented bound of the sample).

    `learn_from` is a condition on `__id`. Without labelled rows the model scores 0.5 everywhere.
    """
    sample = labelled_sample(docs, labels, label, learn_from, per_class, (0, 1))
    kind = sample.schema["__id"].dataType.simpleString()

    def make():
        features = Features()

        def fill(batch):
            return (batch.column("__id"), batch.column("label"),
                    [features(t).astype(np.int32) for t in texts_of(batch)])
        return fill

    got = map_batches(sample, f"id {kind}, label int, features array<int>", make).toArrow()
    got = sorted(zip(got["id"].to_pylist(), got["label"].to_pylist(),
                     (np.asarray(x.values if x is not None else [], np.int32) for x in got["features"])),
                 key=lambda row: (row[0], row[1], len(row[2])))
    if not got:
        return QualityModel(np.zeros(SIZE, np.float32), 0.0, (0.0, 0.0)), np.zeros(SIZE, np.float32)
    order = np.random.default_rng(3).permutation(len(got))
    return fit([got[i][2] for i in order], np.array([got[i][1] for i in order], np.float64))


def score_quality(docs: DataFrame, model: tuple[QualityModel, np.ndarray], text_column: str = "text",
                  score: str = "score") -> DataFrame:
    """All columns of `docs` and the score (0 to 1, higher: class 1 likelier), whole texts, no shuffle.

    Null and empty texts get the calibrated intercept. A clashing column named as the score is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.drop(score).withColumn(score, F.lit(0.0)).schema
    names = [f.name for f in schema.fields][:-1]

    def run(batches):
        features = Features()
        fitted, norm = sent.value
        a, b = fitted.scale
        import pyarrow as pa
        for batch in in_parts(batches):
            margins = np.array([fitted.margin(features(t), norm) for t in texts_of(batch, text_column)])
            columns = [batch.column(n) for n in names] + [pa.array(sigmoid(a * margins + b), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, score])

    return docs.drop(score).mapInArrow(run, schema)
