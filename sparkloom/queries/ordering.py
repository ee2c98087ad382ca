"""Sort, limit and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.registry import query, table
from sparkloom.scratch import new_dir


@query("sort_global", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey")
def sort_global(spark, sf_dir):
    """The unique second key also splits runs of equal prices over tasks."""
    return (table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")))


@query("sort_roundtrip", "select p_partkey, p_retailprice from part")
def sort_roundtrip(spark, sf_dir):
    """Files sorted inside each partition, read again and sorted as a whole."""
    path = new_dir(spark, "sorted")
    (table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
     .sortWithinPartitions("p_retailprice", "p_partkey").write.parquet(path))
    return spark.read.parquet(path).orderBy("p_retailprice", "p_partkey")


@query("limit_ordered", "select o_orderkey, o_orderdate from orders order by o_orderdate, o_orderkey limit 20")
def limit_ordered(spark, sf_dir):
    return (table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
            .orderBy("o_orderdate", "o_orderkey").limit(20))


@query("topk", """
    select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem
    order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey limit 10""")
def topk(spark, sf_dir):
    """Each task keeps its ten largest, then they are merged."""
    return (table(spark, sf_dir, "lineitem")
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
            .orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(10))


@query("union_all", """
    select c_custkey as id, c_name as name, cast(null as timestamp) as at from customer
    union all select s_suppkey, s_name, null from supplier
    union all select o_orderkey, o_orderpriority, cast(cast(o_orderdate as date) as timestamp) from orders""")
def union_all(spark, sf_dir):
    """By position; a DATE column united with a TIMESTAMP one becomes midnight."""
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit(None).cast("timestamp_ntz"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.lit(None).cast("timestamp_ntz"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate"))
    return people.union(suppliers).union(orders).toDF("id", "name", "at")


@query("union_by_name", """
    select c_custkey as id, c_name as name, c_mktsegment as segment from customer
    union all select s_suppkey, s_name, null from supplier""")
def union_by_name(spark, sf_dir):
    """By name, in any column order, a missing column being null."""
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                                     F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"),
                                                        F.col("s_suppkey").alias("id"))
    return people.unionByName(suppliers, allowMissingColumns=True)
