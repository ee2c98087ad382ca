"""Source queries: each table is written in the source's format and must come back unchanged."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions.schema import infer_json_schema
from sparkloom.functions.timestamps import as_instant, as_ntz
from sparkloom.operators.positions import group_row_number
from sparkloom.registry import query, table
from sparkloom.scratch import stage_once
from sparkloom.sources import connectors, files, writers

ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")
ORDERS_ALL = "select * from orders"


def _orders_csv(spark, sf_dir, header):
    label = "orders-csv" if header else "orders-csv-headerless"
    return stage_once(spark, sf_dir, label,
                      lambda path: writers.write_csv(table(spark, sf_dir, "orders"), path, header=header))


@query("src_range", """
    select ids.id, cast(count(l.l_orderkey) as bigint) as n_lines
    from (select unnest(range((select min(o_orderkey) from orders),
                              (select max(o_orderkey) + 1 from orders))) as id) ids
    left join lineitem l on l.l_orderkey = ids.id
    group by ids.id""")
def src_range(spark, sf_dir):
    """Every id of the key range with its number of lines, ids without lines included."""
    low, high = table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    ids = spark.range(low, high + 1, 1, numPartitions=spark.sparkContext.defaultParallelism)
    lines = (table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id"))
             .agg(F.count(F.lit(1)).alias("n_lines")))
    return ids.join(lines, "id", "left").na.fill({"n_lines": 0})


@query("src_csv_infer", ORDERS_ALL)
def src_csv_infer(spark, sf_dir):
    df = files.csv_inferred(spark, _orders_csv(spark, sf_dir, True))
    return df.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus",
                     "o_totalprice", as_ntz("o_orderdate").alias("o_orderdate"), "o_orderpriority")


@query("src_csv_schema", ORDERS_ALL)
def src_csv_schema(spark, sf_dir):
    return files.csv_declared(spark, _orders_csv(spark, sf_dir, True), ORDERS_DDL)


@query("src_csv_headerless", ORDERS_ALL)
def src_csv_headerless(spark, sf_dir):
    schema = T.StructType.fromDDL(ORDERS_DDL)
    raw = files.csv_headerless(spark, _orders_csv(spark, sf_dir, False), schema.fieldNames())
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


@query("src_csv_json_schema", ORDERS_ALL)
def src_csv_json_schema(spark, sf_dir):
    """The schema travels as a JSON string."""
    text = files.schema_to_string(table(spark, sf_dir, "orders").schema)
    return files.csv_declared(spark, _orders_csv(spark, sf_dir, True), files.schema_from_string(text))


@query("src_text_grep", """
    select value, cast(length(value) as int) as n_chars
    from (select unnest(string_split(text, chr(10))) as value from documents)
    where contains(value, 'license')""")
def src_text_grep(spark, sf_dir):
    """Lines of the texts, written and scanned as text files, that contain a word."""
    path = stage_once(spark, sf_dir, "documents-text",
                      lambda p: table(spark, sf_dir, "documents").select("text").write
                      .option("lineSep", "\n").text(p))
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.filter(F.col("value").contains("license")).select("value", F.length("value").alias("n_chars"))


@query("src_json", "select * from customer")
def src_json(spark, sf_dir):
    path = stage_once(spark, sf_dir, "customer-json",
                      lambda p: table(spark, sf_dir, "customer").write.json(p))
    df = spark.read.json(path)
    return df.select("c_custkey", "c_name", F.col("c_nationkey").cast("int"), "c_acctbal", "c_mktsegment")


@query("json_strings", """
    select event_id, cast(json_extract(props, '$.k') as bigint) as k from events""")
def json_strings(spark, sf_dir):
    """A column of JSON text parsed with the schema inferred from all of its rows."""
    events = table(spark, sf_dir, "events")
    schema = infer_json_schema(events, "props")
    return events.select("event_id", F.from_json("props", schema).alias("p")).select("event_id", "p.k")


CUSTOMER_JSON_SQL = """concat('{"c_custkey":', c_custkey, ',"c_name":"', c_name, '","c_nationkey":',
    c_nationkey, ',"c_mktsegment":"', c_mktsegment, '"}')"""


@query("json_corrupt_rows", f"""
    with src as (select *, {CUSTOMER_JSON_SQL} as line, c_nationkey = 7 as broken from customer)
    select case when not broken then c_custkey end as c_custkey,
           case when not broken then c_name end as c_name,
           case when not broken then c_nationkey end as c_nationkey,
           case when broken then substr(line, 1, length(line) - 4) end as corrupt
    from src""")
def json_corrupt_rows(spark, sf_dir):
    """Malformed lines (cut off at the end) are kept whole beside the valid rows."""
    def write(path):
        line = F.to_json(F.struct("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
        cut = F.when(F.col("c_nationkey") == 7, F.substring(line, F.lit(1), F.length(line) - 4)).otherwise(line)
        table(spark, sf_dir, "customer").select(cut.alias("value")).write.text(path)

    path = stage_once(spark, sf_dir, "customer-broken-json", write)
    schema = T.StructType.fromDDL("c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string")
    return (files.json_permissive(spark, path, schema)
            .select("c_custkey", "c_name", "c_nationkey", F.col("_corrupt_record").alias("corrupt")))


@query("src_parquet", """
    select l_orderkey, l_partkey, l_quantity from lineitem where l_quantity >= 45""")
def src_parquet(spark, sf_dir):
    """Default format; the filter and the three columns reach the scan."""
    return (spark.read.load(f"{sf_dir}/lineitem.parquet").filter(F.col("l_quantity") >= 45)
            .select("l_orderkey", "l_partkey", "l_quantity"))


@query("src_orc", "select * from part")
def src_orc(spark, sf_dir):
    path = stage_once(spark, sf_dir, "part-orc", lambda p: table(spark, sf_dir, "part").write.orc(p))
    return spark.read.orc(path)


@query("src_partitioned", ORDERS_ALL)
def src_partitioned(spark, sf_dir):
    """JSON in directories per status and priority; both columns come back from the paths."""
    path = stage_once(spark, sf_dir, "orders-partitioned-json",
                      lambda p: writers.write_partitioned(table(spark, sf_dir, "orders"), p,
                                                          ["o_orderstatus", "o_orderpriority"], "json"))
    return spark.read.schema(ORDERS_DDL).json(path).select(*T.StructType.fromDDL(ORDERS_DDL).fieldNames())


@query("src_merge_schema", """
    select o_orderkey, o_custkey,
           case when o_orderdate >= timestamp '1998-01-01' then o_totalprice end as o_totalprice
    from orders""")
def src_merge_schema(spark, sf_dir):
    """Old files lack the price column, newer ones have it."""
    def write(path):
        orders = table(spark, sf_dir, "orders")
        new = F.col("o_orderdate") >= F.expr("timestamp_ntz'1998-01-01'")
        orders.filter(~new).select("o_orderkey", "o_custkey").write.mode("append").parquet(path)
        orders.filter(new).select("o_orderkey", "o_custkey", "o_totalprice").write.mode("append").parquet(path)

    return (files.parquet_merged(spark, stage_once(spark, sf_dir, "orders-evolved", write))
            .select("o_orderkey", "o_custkey", "o_totalprice"))


@query("src_multi_path", "select o_orderkey, o_custkey, o_totalprice from orders")
def src_multi_path(spark, sf_dir):
    """All paths that were written, one per status, and one that does not exist."""
    path = stage_once(spark, sf_dir, "orders-by-status",
                      lambda p: writers.write_partitioned(
                          table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                                                "o_orderstatus"), p, ["o_orderstatus"]))
    written = sorted({file.rsplit("/", 1)[0] for file in spark.read.parquet(path).inputFiles()})
    return files.parquet_existing(spark, [f"{path}/o_orderstatus=missing", *written])


# --- Kafka replica: events as a stored topic with the connector's seven columns ----------------

TOPIC = "events"
TOPIC_PARTITIONS = 4
EVENT_VALUE = "event_id bigint, user_id bigint, event_type string, value double"


def event_topic(spark, sf_dir):
    """Partition by id, offsets without gaps per partition in id order."""
    def write(path):
        events = table(spark, sf_dir, "events").withColumn(
            "partition", F.pmod(F.col("event_id"), F.lit(TOPIC_PARTITIONS)).cast("int"))
        placed = group_row_number(events, ["partition"], ["event_id"], "rn")
        value = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
        (placed.select(F.col("user_id").cast("string").cast("binary").alias("key"),
                       value.cast("binary").alias("value"), F.lit(TOPIC).alias("topic"), "partition",
                       (F.col("rn") - 1).alias("offset"), F.col("ts").alias("timestamp"),
                       F.lit(0).alias("timestampType"))
               .write.parquet(path))

    return spark.read.parquet(stage_once(spark, sf_dir, "event-topic", write))


TOPIC_SQL = """select event_id, user_id, event_type, value,
        cast(event_id % 4 as int) as part,
        row_number() over (partition by event_id % 4 order by event_id) - 1 as off
    from events"""


@query("kafka_decode", f"""
    select 'events' as topic, part as "partition", cast(off as bigint) as "offset",
           event_id, user_id, event_type, value
    from ({TOPIC_SQL})""")
def kafka_decode(spark, sf_dir):
    return connectors.kafka_decode(event_topic(spark, sf_dir), EVENT_VALUE)


@query("kafka_offset_range", f"""
    with t as ({TOPIC_SQL}), e as (select part, max(off) + 1 as ends from t group by part)
    select t.part as "partition", cast(t.off as bigint) as "offset", t.event_id
    from t join e on t.part = e.part
    where t.off >= e.ends // 4 and t.off < (e.ends * 3) // 4""")
def kafka_offset_range(spark, sf_dir):
    """The middle half of every partition: start offset inclusive, end offset exclusive."""
    topic = as_instant(event_topic(spark, sf_dir), "timestamp")
    ends = connectors.end_offsets(topic)
    part = connectors.in_offset_range(topic, {p: e // 4 for p, e in ends.items()},
                                      {p: e * 3 // 4 for p, e in ends.items()})
    return connectors.kafka_decode(part, EVENT_VALUE).select("partition", "offset", "event_id")


@query("sql_entry", """
    select o_orderstatus, count(*) as n, min(o_totalprice) as lowest from orders group by o_orderstatus""")
def sql_entry(spark, sf_dir):
    return spark.sql("select o_orderstatus, count(*) as n, min(o_totalprice) as lowest "
                     "from {orders} group by o_orderstatus", orders=table(spark, sf_dir, "orders"))
