"""Run a stream over everything that is available and give the result as a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sparkloom.scratch import new_dir

BatchWriter = Callable[[DataFrame, int], None]


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process all available input in micro-batches, then stop; a failure of the stream is raised.

    The state store and its number of partitions are the session's (see `session.state_settings`).
    """
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_until_drained(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Run micro-batches one after another until the source has nothing more, then stop; a failure is raised.

    For sources whose batches are bounded by themselves: `availableNow` would ask them for one batch only.
    """
    query = writer.option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def start_empty(df: DataFrame, path: str) -> None:
    """An empty table at the target, which is the result if no micro-batch ever runs."""
    df.sparkSession.createDataFrame([], df.schema).write.parquet(path)


def append_result(df: DataFrame) -> DataFrame:
    """Append mode into a parquet sink, whose log makes every batch count once."""
    spark = df.sparkSession
    out = new_dir(spark, "stream-append")
    start_empty(df, out)
    writer = df.writeStream.outputMode("append").format("parquet").option("path", out)
    run_available(writer, new_dir(spark, "checkpoint"))
    return spark.read.schema(df.schema).parquet(out)


def append_more(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Process what has come since the last run with this checkpoint, or all on the first one, into a parquet sink.

    The checkpoint's offset and commit logs say what is done and its state store what was seen, so a query that is
    started again, by another process or after a failure, goes on as if it had never stopped. The plan must keep its
    sources and stateful steps.
    """
    return run_available(df.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint)


def per_batch_writer(path: str) -> BatchWriter:
    """Each micro-batch in a directory of its own, so a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def complete_result(df: DataFrame) -> DataFrame:
    """Complete mode: every batch writes the whole result; the last one is the answer."""
    spark = df.sparkSession
    out = new_dir(spark, "stream-complete")
    last = {"id": -1}
    start_empty(df, f"{out}/batch_id=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        per_batch_writer(out)(batch, batch_id)
        last["id"] = batch_id

    run_available(df.writeStream.outputMode("complete").foreachBatch(write), new_dir(spark, "checkpoint"))
    return spark.read.schema(df.schema).parquet(f"{out}/batch_id={last['id']}")


def update_result(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update mode: batches hold changed rows only; a key's newest batch has its value."""
    spark = df.sparkSession
    out = new_dir(spark, "stream-update")
    start_empty(df, f"{out}/batch_id=-1")
    run_available(df.writeStream.outputMode("update").foreachBatch(per_batch_writer(out)),
                  new_dir(spark, "checkpoint"))
    rest = [c for c in df.columns if c not in keys]
    changes = spark.read.parquet(out)
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("__row"))
    return newest.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])
