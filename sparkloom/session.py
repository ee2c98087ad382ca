"""Session settings the operators are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# UTC keeps zone-less parquet timestamps and event-time columns on one clock. Adaptive execution
# re-plans at runtime: it merges small shuffle partitions and splits skewed join partitions.
DEFAULTS = {
    # Skewed partitions of joins between a stream and a static table are split too.
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# Large streaming state lives off-heap and is saved as increments.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One store per partition for both sides of a join.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def state_settings(spark: SparkSession) -> dict[str, str]:
    """Settings for queries that keep state: the store, and partitions for it, which a checkpoint fixes for
    good: the session's shuffle partitions, but no more than two per core."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {**STATE_STORE,
            "spark.sql.shuffle.partitions": str(min(wanted, 2 * spark.sparkContext.defaultParallelism))}


# Sizes beyond which Spark's own defaults hold.
_MOST_ADVISORY, _MOST_SKEWED, _LEAST_BYTES = 64 << 20, 256 << 20, 16 << 10


def skew_settings(table_bytes: int, partitions: int) -> dict[str, str]:
    """Settings under which adaptive execution splits skewed partitions of a shuffle of this size: a partition of
    twice the even share is skewed, and its parts are a quarter of a share. Large tables get Spark's defaults."""
    share = max(1, table_bytes // max(1, partitions))
    return {
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(min(_MOST_SKEWED, max(_LEAST_BYTES, share))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(_MOST_ADVISORY, max(_LEAST_BYTES, share // 4))),
    }


def child_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of the same application with the caller's settings and some of its own, which the caller's
    session and other threads do not get."""
    child = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if child.conf.isModifiable(key):
            child.conf.set(key, value)
    return child


def get_session(app: str = "sparkloom", master: str | None = None, **extra: str) -> SparkSession:
    """Build or fetch a session; `master` is given only for local runs."""
    builder = SparkSession.builder.appName(app)
    settings = {**DEFAULTS, **STATE_STORE}
    if master:
        cores = os.environ.get("BENCH_CPUS", "8")
        builder = builder.master(master)
        settings.update({
            "spark.sql.shuffle.partitions": cores,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        })
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
