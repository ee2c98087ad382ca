"""Sink queries: what was written is read back and compared with the table it came from."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.registry import query, table
from sparkloom.scratch import new_dir
from sparkloom.sources import connectors, inserts, writers

from sparkloom.queries.sources import CUSTOMER_JSON_SQL


@query("sink_modes", "select o_orderkey, o_orderstatus, o_totalprice from orders")
def sink_modes(spark, sf_dir):
    """Overwrite, append, then an ignored write that must change nothing."""
    path = new_dir(spark, "modes")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    orders.write.parquet(path)
    orders.filter(F.col("o_orderstatus") == "F").write.mode("overwrite").parquet(path)
    orders.filter(F.col("o_orderstatus") != "F").write.mode("append").parquet(path)
    orders.write.mode("ignore").parquet(path)
    return spark.read.parquet(path)


@query("sink_observed", """
    select count(*) as n, count(case when l_returnflag = 'R' then 1 end) as returned,
           cast(sum(cast(l_quantity as decimal(18,2))) as double) as quantity,
           min(l_shipdate) as earliest, max(l_orderkey) as highest
    from lineitem""")
def sink_observed(spark, sf_dir):
    """Figures of a write, taken while it runs: the table is scanned once."""
    lines = table(spark, sf_dir, "lineitem")
    seen = writers.write_observed(
        lines, new_dir(spark, "observed"), n=F.count(F.lit(1)), returned=F.count(F.when(F.col("l_returnflag") == "R", 1)),
        quantity=F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double"), earliest=F.min("l_shipdate"),
        highest=F.max("l_orderkey"))
    return spark.createDataFrame([tuple(seen.values())], "n bigint, returned bigint, quantity double, "
                                 "earliest timestamp_ntz, highest bigint").toDF(*seen)


@query("sink_text", """
    select concat(o_orderkey, '|', o_orderstatus, '|', o_orderpriority) as value from orders""")
def sink_text(spark, sf_dir):
    path = new_dir(spark, "text")
    (table(spark, sf_dir, "orders")
     .select(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority"))
     .write.text(path))
    return spark.read.text(path)


@query("sink_dynamic_overwrite", """
    select o_orderkey, o_custkey + case when o_orderstatus = 'F' then 1000000 else 0 end as o_custkey,
           o_orderstatus
    from orders""")
def sink_dynamic_overwrite(spark, sf_dir):
    """Only the partition that occurs in the second write is replaced."""
    path = new_dir(spark, "dynamic")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    writers.write_partitioned(orders, path, ["o_orderstatus"])
    changed = orders.filter(F.col("o_orderstatus") == "F").withColumn("o_custkey", F.col("o_custkey") + 1000000)
    writers.overwrite_partitions(changed, path, ["o_orderstatus"])
    return spark.read.parquet(path)


@query("sink_route_by_date", """
    select event_id, event_type, strftime(ts, '%Y-%m-%d') as date from events""")
def sink_route_by_date(spark, sf_dir):
    """The target of each row follows its date: one directory per day."""
    path = new_dir(spark, "by-date")
    events = (table(spark, sf_dir, "events")
              .select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("date")))
    writers.write_partitioned(events, path, ["date"])
    return spark.read.parquet(path).withColumn("date", F.col("date").cast("string"))


@query("json_roundtrip", "select * from part")
def json_roundtrip(spark, sf_dir):
    """Rows as one JSON column in parquet and back."""
    part = table(spark, sf_dir, "part")
    path = new_dir(spark, "json-rows")
    part.select(F.to_json(F.struct("*")).alias("value")).write.parquet(path)
    return spark.read.parquet(path).select(F.from_json("value", part.schema).alias("v")).select("v.*")


@query("kafka_encode", f"""
    select cast(c_nationkey as varchar) as key, {CUSTOMER_JSON_SQL} as value, 'customers' as topic
    from customer""")
def kafka_encode(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return connectors.kafka_encode(customer, "customers", F.col("c_nationkey"))


@query("render_inserts", """
    select concat('INSERT INTO TABLE foo (event_id, ts, event_type) VALUE (', event_id, 'L, ts:',
                  epoch_us(ts), ', ''', event_type, ''')') as statement
    from events""")
def render_inserts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return inserts.render_inserts(events, "foo")
