"""Physical layout queries."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from sparkloom.operators import layout, partitionwise
from sparkloom.registry import query, table


@query("layout_partition_counts", """
    select l_orderkey // 4 as order_group, count(*) as n, 1::bigint as partitions, true as all_here
    from lineitem group by 1""")
def layout_partition_counts(spark, sf_dir):
    """Rows per partition after repartitioning by an expression: each value lies in one partition only, and
    that partition holds all its rows."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = table(spark, sf_dir, "lineitem").select(F.expr("l_orderkey div 4").alias("order_group"))
    counts = layout.partition_counts(lines.repartition(partitions, "order_group"), "order_group")
    return counts.groupBy("order_group").agg(
        F.sum("n").alias("n"), F.count_distinct("partition_id").alias("partitions"),
        (F.max("n") == F.sum("n")).alias("all_here"))


class PropsParser:
    """A resource of a task: parses JSON texts and remembers up to `most` of them."""

    def __init__(self, most: int = 100_000):
        self._decoder, self._known, self._most = json.JSONDecoder(), {}, most

    def k(self, text: str | None) -> int | None:
        if text is None:
            return None
        if text not in self._known:
            if len(self._known) >= self._most:
                self._known.clear()
            self._known[text] = self._decoder.decode(text).get("k")
        return self._known[text]

    def close(self) -> None:
        self._known.clear()


@query("map_partitions", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def map_partitions(spark, sf_dir):
    """One parser per task serves all of its batches and is closed at the end."""
    events = table(spark, sf_dir, "events").select("event_id", "props")

    def parse(parser, batch):
        return batch.assign(k=batch["props"].map(parser.k).astype("Int64"))[["event_id", "k"]]

    return partitionwise.map_partitions(events, "event_id bigint, k bigint", PropsParser, parse, PropsParser.close)
