"""Option sets for external systems.

The connector jars and the servers are the deployment's part: these builders return exactly what goes
into `.options(...)`, so the same settings serve batch reads, streams and writes.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OffsetSpec = Mapping[str, Mapping[int, int]]


# --- JDBC -------------------------------------------------------------------------------------

def jdbc_options(url: str, table: str, driver: str | None = None, **extra: str) -> dict[str, str]:
    options = {"url": url, "dbtable": table}
    if driver:
        options["driver"] = driver
    return {**options, **extra}


def jdbc_partitioned_options(url: str, table: str, column: str, lower: int, upper: int,
                             partitions: int, driver: str | None = None) -> dict[str, str]:
    """Parallel scan; bounds set only the stride, rows outside go to the first and last partition."""
    return jdbc_options(url, table, driver, partitionColumn=column, lowerBound=str(lower),
                        upperBound=str(upper), numPartitions=str(partitions))


def jdbc_predicates(column: str, cuts: Sequence[int]) -> list[str]:
    """One WHERE clause per partition for `spark.read.jdbc(predicates=...)`.

    Together they cover every row once, null keys included. Cuts from `balanced_cuts` keep the
    partitions even where equal strides would leave most rows in one of them.
    """
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def balanced_cuts(df: DataFrame, column: str, partitions: int) -> list[int]:
    """Distinct approximate quantiles of a key, one value fewer than partitions."""
    shares = [i / partitions for i in range(1, partitions)]
    row = df.agg(F.percentile_approx(column, shares, 10_000).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


# --- Elasticsearch ----------------------------------------------------------------------------

def elastic_options(nodes: str, wan_only: bool = False, refresh_on_write: bool = False) -> dict[str, str]:
    return {"es.nodes": nodes,
            "es.nodes.wan.only": str(wan_only).lower(),
            "es.batch.write.refresh": str(refresh_on_write).lower()}


def elastic_read(spark: SparkSession, nodes: str, index_pattern: str, **options: bool) -> DataFrame:
    """One partition per shard; bare `contains` and range filters are pushed to the index."""
    return spark.read.format("es").options(**elastic_options(nodes, **options)).load(index_pattern)


def elastic_index(prefix: str, date_column: str) -> str:
    """Index name that takes its last part from a row column, for instance logs-{date}."""
    return f"{prefix}-{{{date_column}}}"


# --- Cassandra --------------------------------------------------------------------------------

CASSANDRA_FORMAT = "org.apache.spark.sql.cassandra"


def cassandra_options(keyspace: str, table: str) -> dict[str, str]:
    return {"keyspace": keyspace, "table": table}


def cassandra_session_settings(host: str, read_consistency: str = "ONE",
                               write_consistency: str = "ANY") -> dict[str, str]:
    allowed = {"ANY", "ONE", "QUORUM", "ALL"}
    if not {read_consistency, write_consistency} <= allowed:
        raise ValueError(f"consistency must be one of {sorted(allowed)}")
    return {"spark.cassandra.connection.host": host,
            "spark.cassandra.input.consistency.level": read_consistency,
            "spark.cassandra.output.consistency.level": write_consistency}


# --- Kafka ------------------------------------------------------------------------------------

KAFKA_SCHEMA = ("key binary, value binary, topic string, partition int, offset bigint, "
                "timestamp timestamp, timestampType int")


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic}


def offsets_json(offsets: OffsetSpec) -> str:
    """Offsets per topic and partition as the connector reads them."""
    return json.dumps({topic: {str(p): int(o) for p, o in parts.items()}
                       for topic, parts in offsets.items()})


def kafka_range_options(servers: str, topic: str, start: Mapping[int, int],
                        end: Mapping[int, int]) -> dict[str, str]:
    """Batch scan of an offset range: start inclusive, end exclusive, every partition named."""
    if set(start) != set(end):
        raise ValueError("start and end must name the same partitions")
    return {**kafka_options(servers, topic),
            "startingOffsets": offsets_json({topic: start}),
            "endingOffsets": offsets_json({topic: end})}


def kafka_stream_options(servers: str, topic: str, starting: str = "earliest",
                         max_offsets: int | None = None, min_partitions: int | None = None) -> dict[str, str]:
    """Stream settings: the offsets cap is over all partitions, min_partitions splits offset ranges."""
    options = {**kafka_options(servers, topic), "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_encode(df: DataFrame, topic: str, key: Column | None = None) -> DataFrame:
    """Rows as Kafka records: JSON value, topic column, optional key."""
    columns = [F.to_json(F.struct("*")).alias("value"), F.lit(topic).alias("topic")]
    if key is not None:
        columns.insert(0, key.cast("string").alias("key"))
    return df.select(*columns)


def kafka_decode(records: DataFrame, schema) -> DataFrame:
    """JSON values of Kafka records as columns, after the record's topic, partition and offset."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return (records.withColumn("value", parsed)
                   .select("topic", "partition", "offset", "value.*"))


def in_offset_range(records: DataFrame, start: Mapping[int, int], end: Mapping[int, int]) -> DataFrame:
    """The rows of a stored topic that an offset-range scan of the same spec would give.

    The spec has one row per topic partition and is joined, however many there are.
    """
    if set(start) != set(end):
        raise ValueError("start and end must name the same partitions")
    spec = records.sparkSession.createDataFrame([(p, start[p], end[p]) for p in sorted(start)],
                                                "partition int, __from bigint, __to bigint")
    inside = (F.col("offset") >= F.col("__from")) & (F.col("offset") < F.col("__to"))
    return records.join(F.broadcast(spec), "partition").filter(inside).select(*records.columns)


def end_offsets(records: DataFrame) -> dict[int, int]:
    """Exclusive end offset of each partition (one row per topic partition reaches the driver)."""
    rows = records.groupBy("partition").agg((F.max("offset") + 1).alias("end")).collect()
    return {r["partition"]: r["end"] for r in rows}
