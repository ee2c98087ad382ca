"""Work by partition with a resource: opened once per task, used for all its batches, closed whatever happens."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Resource = TypeVar("Resource")


def _no_close(resource) -> None:
    pass


def map_partitions(df: DataFrame, schema: str | T.StructType, open_: Callable[[], Resource],
                   fn: Callable[[Resource, pd.DataFrame], pd.DataFrame],
                   close: Callable[[Resource], None] = _no_close) -> DataFrame:
    """Apply `fn(resource, batch)` to the batches of each partition.

    The resource (a connection, a loaded model) is made by `open_()` in the task when its first batch comes, so an
    empty partition opens none. It is closed after the last batch, on an error, and when the task is stopped before
    it has read all its rows (as by a limit). A partition is never held whole: batches come and go one by one.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource, opened = None, False
        try:
            for batch in batches:
                if not opened:
                    resource, opened = open_(), True
                yield fn(resource, batch)
        finally:
            if opened:
                close(resource)

    return df.mapInPandas(run, schema)


def for_each_partition(df: DataFrame, open_: Callable[[], Resource], fn: Callable[[Resource, pd.DataFrame], None],
                       close: Callable[[Resource], None] = _no_close) -> int:
    """Send all batches of each partition to a resource of its own; gives the number of rows sent.

    A task that fails is run again from its first row: `fn` must bear rows that come twice.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        resource, opened, rows = None, False, 0
        try:
            for batch in batches:
                if not opened:
                    resource, opened = open_(), True
                fn(resource, batch.to_pandas())
                rows += batch.num_rows
        finally:
            if opened:
                close(resource)
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64())], names=["rows"])

    return df.mapInArrow(run, "rows bigint").agg({"rows": "sum"}).first()[0] or 0
