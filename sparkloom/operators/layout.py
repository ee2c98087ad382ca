"""Physical layout at user level: partition counts, key co-location, file layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.joins import planned_bytes


def partition_counts(df: DataFrame, *by: str) -> DataFrame:
    """Rows per partition of a frame (non-empty partitions only), also by further columns."""
    return (df.groupBy(F.spark_partition_id().alias("partition_id"), *by)
              .agg(F.count(F.lit(1)).alias("n")))


def balanced_for_write(df: DataFrame, *keys: str) -> DataFrame:
    """Bring rows of equal keys together for a partitioned write, without one task per hot key.

    Adaptive execution splits a partition that grows beyond the advisory size and merges small ones,
    so small keys get one file and hot keys several of a good size.
    """
    return df.hint("rebalance", *[F.col(k) for k in keys]) if keys else df.hint("rebalance")


#: A table up to this size may lie in a single row group, which is one task's work however many cores there are.
SPREAD_BYTES = 64 * 1024 * 1024


def spread(df: DataFrame, most_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Deal the rows of a small table over all cores before heavy work on each row. Larger tables have row groups
    enough and are not shuffled."""
    if planned_bytes(df) > most_bytes:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def file_partitions(df: DataFrame) -> DataFrame:
    """Pieces of files behind a scan: path, size of the file, byte range and rows of each."""
    names = ("file_path", "file_size", "file_block_start", "file_block_length")
    return (df.select(*[F.col(f"_metadata.{n}").alias(n) for n in names])
              .groupBy(*names).agg(F.count(F.lit(1)).alias("n")))


def reproducible_sample(df: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """A sample that a re-run repeats: rows whose key hash falls below the percentage."""
    return df.filter(F.pmod(F.xxhash64(*keys), F.lit(100)) < percent)


def cached(df: DataFrame) -> DataFrame:
    """Cache and fill all partitions at once; `take` would fill only the ones it reads."""
    df = df.cache()
    df.count()
    return df
