"""Aggregation and window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import aggregates, layout, positions
from sparkloom.registry import query, table

# Money is summed as a decimal, so the order of the rows cannot change the result.
MONEY = "decimal(18,2)"


def money_sum(column: str):
    return F.sum(F.col(column).cast(MONEY)).cast("double")


@query("agg_group_count", "select l_returnflag, count(*) as n from lineitem group by l_returnflag")
def agg_group_count(spark, sf_dir):
    return (table(spark, sf_dir, "lineitem").groupBy("l_returnflag").count()
            .withColumnRenamed("count", "n"))


@query("agg_group_sum", """
    select c_nationkey, cast(sum(cast(c_acctbal as decimal(18,2))) as double) as balance
    from customer group by c_nationkey""")
def agg_group_sum(spark, sf_dir):
    return (table(spark, sf_dir, "customer").groupBy("c_nationkey")
            .agg(money_sum("c_acctbal").alias("balance")))


@query("agg_multi", """
    select o_orderpriority, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
    from orders group by o_orderpriority""")
def agg_multi(spark, sf_dir):
    return (table(spark, sf_dir, "orders").groupBy("o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n"), money_sum("o_totalprice").alias("total")))


@query("agg_collect_list", """
    with o as (select o_custkey, nullif(o_orderkey, o_orderkey // 7 * 7) as k from orders),
    placed as (select o_custkey, k, cast((row_number() over (partition by o_custkey order by k) - 1) // 1000 as int)
                      as chunk from o where k is not null)
    select c.o_custkey, coalesce(p.chunk, 0) as chunk, count(p.k) as n,
           coalesce(array_to_string(list(p.k order by p.k) filter (where p.k is not null), ','), '') as order_keys
    from (select distinct o_custkey from o) c left join placed p on p.o_custkey = c.o_custkey
    group by c.o_custkey, coalesce(p.chunk, 0)""")
def agg_collect_list(spark, sf_dir):
    """Order keys per customer, at most 1000 in a list, further lists in further rows; null keys are skipped."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    orders = orders.withColumn("o_orderkey", F.expr("nullif(o_orderkey, o_orderkey div 7 * 7)"))
    lists = aggregates.collect_list_chunked(orders, ["o_custkey"], "o_orderkey", ["o_orderkey"])
    return lists.select("o_custkey", "chunk", "n", F.array_join("items", ",").alias("order_keys"))


@query("agg_max", """
    select o_orderstatus, max(o_totalprice) as highest, (select max(o_totalprice) from orders) as highest_of_all
    from orders group by o_orderstatus""")
def agg_max(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    by_status = orders.groupBy("o_orderstatus").agg(F.max("o_totalprice").alias("highest"))
    overall = by_status.agg(F.max("highest").alias("m"))
    return by_status.withColumn("highest_of_all", overall.scalar())


# The values of o_orderpriority, which the SQL has to spell out.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PIVOT_SQL = "select o_custkey, " + ", ".join(
    f"cast(sum(case when o_orderpriority = '{p}' then cast(o_totalprice as decimal(18,2)) end) as double) as \"{p}\""
    for p in PRIORITIES) + " from orders group by o_custkey"


@query("agg_pivot", PIVOT_SQL)
def agg_pivot(spark, sf_dir):
    """A column per priority that occurs; a customer without orders of a priority has a null cell."""
    wide = aggregates.pivot_sum(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority",
                                F.col("o_totalprice").cast(MONEY))
    return wide.select("o_custkey", *[F.col(f"`{c}`").cast("double").alias(c) for c in wide.columns[1:]])


@query("agg_global", """
    select count(*) as n, cast(sum(length(text)) as bigint) as total_chars, max(length(text)) as longest
    from documents""")
def agg_global(spark, sf_dir):
    return (table(spark, sf_dir, "documents").select(F.length("text").cast("bigint").alias("len"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("total_chars"), F.max("len").alias("longest")))


@query("agg_distinct", "select distinct l_partkey, l_suppkey from lineitem")
def agg_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("agg_multi_key", """
    select o_orderstatus, o_orderpriority, count(*) as n from orders group by 1, 2""")
def agg_multi_key(spark, sf_dir):
    return (table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n")))


SHARE_SQL = """select a.o_orderstatus, a.o_orderpriority, a.n as cnt_ab, b.n as cnt_a,
        cast((10000 * a.n) // b.n as bigint) as share_bp
    from (select o_orderstatus, o_orderpriority, count(*) as n from orders group by 1, 2) a
    join (select o_orderstatus, count(*) as n from orders group by 1) b
      on a.o_orderstatus = b.o_orderstatus"""


@query("agg_percent_join", SHARE_SQL)
def agg_percent_join(spark, sf_dir):
    return aggregates.share_of_group(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("win_percent", """
    select o_orderkey, o_orderstatus, o_orderpriority,
           count(*) over (partition by o_orderstatus) as cnt_a,
           count(*) over (partition by o_orderstatus, o_orderpriority) as cnt_ab,
           cast((10000 * count(*) over (partition by o_orderstatus, o_orderpriority))
                // count(*) over (partition by o_orderstatus) as bigint) as share_bp
    from orders""")
def win_percent(spark, sf_dir):
    """Both counts on every row, without a task that holds a whole status."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return aggregates.with_share_of_group(orders, "o_orderstatus", "o_orderpriority")


@query("agg_salted", "select l_returnflag, count(*) as n from lineitem group by l_returnflag")
def agg_salted(spark, sf_dir):
    return aggregates.salted_count(table(spark, sf_dir, "lineitem"), "l_returnflag",
                                   ["l_orderkey", "l_linenumber"])


@query("agg_top_groups", """
    select o_orderpriority, count(*) as n from orders
    where o_totalprice > 100000 and o_orderstatus in ('F', 'O')
    group by o_orderpriority order by n desc""")
def agg_top_groups(spark, sf_dir):
    """Flagship: filter, group, count, largest groups first, groups with a null key dropped."""
    return (table(spark, sf_dir, "orders")
            .filter((F.col("o_totalprice") > 100000) & F.col("o_orderstatus").isin("F", "O"))
            .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "o_orderpriority")
            .na.drop("any"))


@query("agg_letter_count", """
    select letter, count(*) as n
    from (select unnest(string_split(lower(text), '')) as letter from documents)
    where trim(letter) <> '' and letter <> chr(10) group by letter""")
def agg_letter_count(spark, sf_dir):
    """Characters of all texts, lower-cased, without blanks and line ends."""
    return (aggregates.letter_counts(layout.spread(table(spark, sf_dir, "documents").select("text")), "text")
            .filter(F.col("letter") != "\n"))


@query("agg_max_topk", """
    select o_custkey, max(o_totalprice) as highest from orders
    group by o_custkey order by highest desc, o_custkey limit 10""")
def agg_max_topk(spark, sf_dir):
    """Largest value per key, then the ten largest."""
    return (table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("highest"))
            .orderBy(F.desc("highest"), "o_custkey").limit(10))


@query("win_row_number", """
    select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc, o_orderkey) as rn
    from orders""")
def win_row_number(spark, sf_dir):
    """A row number over the whole table without a single-partition sort."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return positions.global_row_number(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("win_group_row_number", """
    select o_orderkey, o_orderstatus,
           row_number() over (partition by o_orderstatus order by o_totalprice, o_orderkey) as rn
    from orders""")
def win_group_row_number(spark, sf_dir):
    """A row number within few, huge groups."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return (positions.group_row_number(orders, ["o_orderstatus"], ["o_totalprice", "o_orderkey"])
            .drop("o_totalprice"))


@query("win_global_count", "select p_partkey, p_brand, count(*) over () as n from part")
def win_global_count(spark, sf_dir):
    return aggregates.with_global_count(table(spark, sf_dir, "part").select("p_partkey", "p_brand"))
