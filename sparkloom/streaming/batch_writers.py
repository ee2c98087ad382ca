"""foreachBatch writers: category fan-out and several sinks at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sparkloom.operators.layout import balanced_for_write
from sparkloom.streaming.runner import BatchWriter


def third_letter(column: str) -> Column:
    """Category of an identifier: its third character, null when it is shorter."""
    return F.nullif(F.substring(column, 3, 1), F.lit(""))


def fan_out(path: str, category: Column, name: str = "name") -> BatchWriter:
    """Write a micro-batch to one directory per category in a single job.

    One partitioned write replaces a filtered write per category, and Spark runs its tasks in
    parallel. The batch number is the inner partition and only partitions present in the data are
    replaced, so a repeated batch leaves no duplicates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(name, category).withColumn("batch_id", F.lit(batch_id))
        (balanced_for_write(rows, name).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(name, "batch_id").parquet(path))
    return write


def to_all(writers: Sequence[BatchWriter], threads: int = 4) -> BatchWriter:
    """One micro-batch to several sinks at the same time; returns when all are done.

    The batch is cached so that its source is read once, and the first error fails the batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            with ThreadPoolExecutor(max_workers=threads) as pool:
                for done in [pool.submit(w, batch, batch_id) for w in writers]:
                    done.result()
        finally:
            batch.unpersist()
    return write


def counted(writer: BatchWriter, report: Callable[[int, int], None]) -> BatchWriter:
    """Report the row count of each batch, measured while it is written."""
    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        writer(batch.observe(seen, F.count(F.lit(1)).alias("rows")), batch_id)
        report(batch_id, seen.get["rows"])
    return write
