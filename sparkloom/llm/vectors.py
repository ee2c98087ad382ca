"""What the operators on integer vectors share: floored components, blocks of rows, sums of rows by slot."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components of this size or more are an error: sums of squares of up to 64 of them would not fit into 64 bits.
MOST = 1 << 26


def all_finite(vector: str) -> Column:
    """Whether a vector is there and has no null or non-finite component."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))


def floored(vector: str, scale: int) -> Column:
    """The vector with each component x as the integer floor(scale * x), x as double."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    large = F.exists(vector, lambda x: F.abs(x.cast("double")) * F.lit(float(scale)) >= F.lit(float(MOST)))
    return F.when(large, F.raise_error(F.lit(f"a component times {scale} is {MOST} or more"))).otherwise(
        scaled.cast("array<int>"))


def matrix_of(batch: pa.RecordBatch, name: str = "v") -> np.ndarray:
    """The batch's vectors, all of one length and without nulls, as rows of 64-bit integers."""
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)


def slot_sums(rows: DataFrame, columns: list[str], add, slots: int) -> list[int]:
    """Sums over all rows: each task adds up an array of `slots` numbers with `add(batch, array)`, and Spark adds
    these arrays slot by slot. Only the final numbers, as many as there are slots, reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for batch in batches:
            add(batch, total)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                                         names=["slot", "total"])

    sums = [0] * slots
    for slot, total in (rows.select(*columns).mapInArrow(run, "slot int, total bigint")
                        .groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect()):
        sums[slot] = int(total)
    return sums
