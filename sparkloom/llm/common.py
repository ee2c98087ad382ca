"""What the text operators share: Arrow mapping by batch, bounded labelled samples, written tables, folds."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparkloom.scratch import freeze

#: Words in the sense of the near-duplicate operators: runs without ASCII white space.
ASCII_SPACE = " \t\n\x0b\x0c\r"

Fill = Callable[[pa.RecordBatch], Iterable]


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, few at a time: Python objects are made for these only."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_batches(df: DataFrame, schema: str, make: Callable[[], Fill], part_rows: int = 1000) -> DataFrame:
    """Apply `make()` once per task and its result to every Arrow batch; it gives the output's columns.

    The columns come back in the schema's order, as Arrow or numpy arrays or as lists. Nothing is kept
    between batches but what `make` built, and a batch is worked on in parts, so memory is bounded.
    """
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill = make()
        for batch in in_parts(batches, part_rows):
            columns = fill(batch)
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
                 for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The batch's texts, null as empty."""
    return [t if t is not None else "" for t in batch.column(name).to_pylist()]


def fold(id_column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, per_class: int,
                    classes: Iterable, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(__id, text, label) of at most `per_class` labelled ids of each class, by hash of the id; written, so that
    `docs` is read once.

    Ids and labels are picked first; only these few rows, of a size bounded by the parameter, are
    broadcast to fetch their texts. An id that is repeated counts once, with the least of its texts.
    """
    known = (labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
             .groupBy(F.col(id_column).alias("__id")).agg(F.max(label).alias("__label")))
    if learn_from is not None:
        known = known.filter(learn_from)
    picked = None
    for value in classes:
        part = known.filter(F.col("__label") == value).orderBy(F.xxhash64("__id"), "__id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    found = (docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("text"))
             .join(F.broadcast(picked), "__id").groupBy("__id")
             .agg(F.min("text").alias("text"), F.first("__label").alias("label")))
    return freeze(docs.sparkSession, found, "labelled-sample")


def broadcast_counted(df: DataFrame, most_rows: int) -> DataFrame:
    """Hint a broadcast of a written table of narrow rows only when its count is within the bound; beyond it
    Spark joins by a shuffle. The result is the same."""
    return F.broadcast(df) if df.count() <= most_rows else df


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


def fit_platt(margin: np.ndarray, target: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) of sigmoid(a * margin + b) by Newton steps on the smoothed log loss (Platt's targets)."""
    positive = float(target.sum())
    negative = float(len(target) - positive)
    goal = np.where(target > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    features = np.stack([margin, np.ones_like(margin)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(features @ beta)
        gradient = features.T @ (p - goal) + 1e-6 * beta
        hessian = (features * (p * (1 - p))[:, None]).T @ features + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


class WordCache(dict):
    """Word to value, computed on a miss and kept up to a bound, so a worker's memory stays bounded."""

    def __init__(self, compute: Callable[[str], object], limit: int = 300_000):
        super().__init__()
        self._compute, self._limit = compute, limit

    def __missing__(self, word: str):
        value = self._compute(word)
        if len(self) < self._limit:
            self[word] = value
        return value
