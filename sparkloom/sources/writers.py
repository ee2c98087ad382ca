"""File sinks: formats, save modes, partitioned and routed writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation

from sparkloom.operators.layout import balanced_for_write


def write_csv(df: DataFrame, path: str, header: bool = False, compression: str | None = None,
              mode: str = "errorifexists") -> None:
    """CSV; no header line unless asked for."""
    writer = df.write.mode(mode).option("header", header)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def write_partitioned(df: DataFrame, path: str, keys: list[str], fmt: str = "parquet",
                      mode: str = "errorifexists") -> None:
    """Hive-style directories; the key columns live in the paths, not in the files."""
    balanced_for_write(df, *keys).write.mode(mode).partitionBy(*keys).format(fmt).save(path)


def overwrite_partitions(df: DataFrame, path: str, keys: list[str], fmt: str = "parquet") -> None:
    """Replace only the partitions that occur in the data."""
    (balanced_for_write(df, *keys).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).format(fmt).save(path))


def write_observed(df: DataFrame, path: str, fmt: str = "parquet", **metrics: Column) -> dict:
    """Write a frame and give aggregates of the written rows, measured by the write itself: the input is read once.

    The aggregates are named. As they are taken in the tasks that write, a row counts once even if a task is run again.
    """
    seen = Observation()
    df.observe(seen, *[m.alias(name) for name, m in metrics.items()]).write.format(fmt).save(path)
    return dict(seen.get)


def write_quietly(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Without the _SUCCESS marker file."""
    (df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
       .format(fmt).save(path))
