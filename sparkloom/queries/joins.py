"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import joins
from sparkloom.registry import query, table
from sparkloom.session import skew_settings


@query("join_inner_using", """
    select o_orderkey as orderkey, o_custkey, l_partkey, l_extendedprice
    from orders join lineitem on o_orderkey = l_orderkey""")
def join_inner_using(spark, sf_dir):
    """`using` keeps one key column."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_partkey",
                                                    "l_extendedprice")
    return orders.join(lines, ["orderkey"], "inner")


@query("join_left_using", """
    with s as (select o_custkey, o_orderstatus, count(*) as n from orders
               where o_totalprice > 200000 group by 1, 2)
    select o_orderkey, o_custkey, o_orderstatus, n
    from orders left join s using (o_custkey, o_orderstatus)""")
def join_left_using(spark, sf_dir):
    """Two key columns; rows without a match keep a null."""
    orders = table(spark, sf_dir, "orders")
    big = (orders.filter(F.col("o_totalprice") > 200000).groupBy("o_custkey", "o_orderstatus")
           .agg(F.count(F.lit(1)).alias("n")))
    return (orders.select("o_orderkey", "o_custkey", "o_orderstatus")
            .join(big, ["o_custkey", "o_orderstatus"], "left")
            .select("o_orderkey", "o_custkey", "o_orderstatus", "n"))


@query("join_expr_alias", """
    select c.c_custkey, c.c_name, n.n_name as nation, r.r_name as region
    from customer c join nation n on c.c_nationkey = n.n_nationkey
                    join region r on n.n_regionkey = r.r_regionkey""")
def join_expr_alias(spark, sf_dir):
    """Aliased frames, an expression over differently named keys, columns picked by alias."""
    c, n, r = (table(spark, sf_dir, t).alias(a)
               for t, a in (("customer", "c"), ("nation", "n"), ("region", "r")))
    return (c.join(n, F.expr("c.c_nationkey = n.n_nationkey"))
             .join(r, F.expr("n.n_regionkey = r.r_regionkey"))
             .select(F.col("c.c_custkey"), F.col("c.c_name"), F.col("n.n_name").alias("nation"),
                     F.col("r.r_name").alias("region")))


@query("join_theta", """
    select s_suppkey, s_nationkey, n_nationkey from supplier join nation on s_nationkey < n_nationkey""")
def join_theta(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey")
    return joins.theta_join(supplier, nation, F.col("s_nationkey") < F.col("n_nationkey"),
                            most_right_rows=1000)


@query("join_broadcast", """
    select s_suppkey, s_name, n_name from supplier join nation on s_nationkey = n_nationkey""")
def join_broadcast(spark, sf_dir):
    """The nation side is small by the optimizer's estimate and broadcast."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return (supplier.join(joins.broadcast_if_small(nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "s_name", "n_name"))


@query("join_sort_merge", """
    select l_orderkey, l_linenumber, l_quantity, o_orderstatus
    from lineitem join orders on l_orderkey = o_orderkey""")
def join_sort_merge(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return (joins.sort_merge_join(lines, orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .drop("o_orderkey"))


@query("join_cartesian", "select s_suppkey, r_regionkey, r_name from supplier cross join region")
def join_cartesian(spark, sf_dir):
    """All pairs with a side of declared size: the output grows with the supplier table only."""
    return joins.cartesian(table(spark, sf_dir, "supplier").select("s_suppkey"),
                           table(spark, sf_dir, "region"), most_right_rows=1000)


@query("join_null_safe", """
    with o as (select o_orderkey, nullif(o_orderpriority, '5-LOW') as priority from orders),
         p as (select priority, count(*) as n from o group by priority)
    select o.o_orderkey, o.priority, p.n from o join p on o.priority is not distinct from p.priority""")
def join_null_safe(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey",
                                                   F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"))
    counts = orders.groupBy("priority").agg(F.count(F.lit(1)).alias("n"))
    return joins.join_aggregate(orders, counts, ["priority"])


@query("join_self_agg", """
    select l_orderkey, l_linenumber, l_partkey, count(*) over (partition by l_partkey) as n from lineitem""")
def join_self_agg(spark, sf_dir):
    """Each line with the number of lines of its part."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.with_group_count(lines, ["l_partkey"])


@query("join_prepartitioned", """
    select l_suppkey, l_orderkey, l_linenumber, count(*) over (partition by l_suppkey) as n from lineitem""")
def join_prepartitioned(spark, sf_dir):
    """One salted hash partitioning feeds the aggregate and the join."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return joins.prepartitioned_self_agg(lines, "l_suppkey", partitions, ["l_orderkey", "l_linenumber"])


@query("join_sliced_union", """
    with days as (select o_orderdate as day, count(*) as orders_that_day from orders group by 1)
    select o_orderkey, o_orderdate as day, orders_that_day
    from orders join days on o_orderdate = day""")
def join_sliced_union(spark, sf_dir):
    """A skewed join cut into date slices that are joined one by one and united."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("day"))
    days = orders.groupBy("day").agg(F.count(F.lit(1)).alias("orders_that_day"))
    bounds = [F.lit(b) for b in joins.slice_bounds(orders, "day", 3)]
    return joins.sliced_join(orders, days, ["day"], "day", bounds).select("o_orderkey", "day", "orders_that_day")


@query("join_salted", """
    select o_orderkey, o_custkey, c_name from orders join customer on o_custkey = c_custkey""")
def join_salted(spark, sf_dir):
    """The skewed join without slices: a salt spreads the hot keys of the big side."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return (joins.salted_join(orders, customer, ["o_custkey"], ["o_orderkey"])
            .select("o_orderkey", "o_custkey", "c_name"))


@query("join_skew_aqe", """
    select l_orderkey, l_linenumber, p_partkey, p_brand
    from (select l_orderkey, l_linenumber, case when l_orderkey % 10 < 7 then 1 else l_partkey end as p_partkey
          from lineitem) join part using (p_partkey)""")
def join_skew_aqe(spark, sf_dir):
    """One key has seven lines of ten. Nothing is salted: adaptive execution splits its partition."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 10 < 7, F.lit(1)).otherwise(F.col("l_partkey")).alias("p_partkey"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in skew_settings(joins.planned_bytes(lines), partitions).items():
        spark.conf.set(key, value)  # the query's own session
    return joins.sort_merge_join(lines, part, ["p_partkey"]).select("l_orderkey", "l_linenumber", "p_partkey", "p_brand")


# Fixed lookup values of the query and its oracle.
SEGMENT_CODES = {"BUILDING": 1, "MACHINERY": 2, "HOUSEHOLD": 3}


@query("lookup_map", """
    select c_custkey, c_mktsegment,
           case c_mktsegment when 'BUILDING' then 1 when 'MACHINERY' then 2 when 'HOUSEHOLD' then 3 end as code
    from customer""")
def lookup_map(spark, sf_dir):
    """Keys missing from the map give null."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", joins.lookup_map(F.col("c_mktsegment"), SEGMENT_CODES).alias("code"))


@query("interval_join", """
    select l.event_id as click_id, r.event_id as purchase_id, l.user_id
    from events l join events r on l.user_id = r.user_id
    where l.event_type = 'click' and r.event_type = 'purchase'
      and l.ts <= r.ts + interval 1 hour and l.ts >= r.ts - interval 1 hour""")
def interval_join(spark, sf_dir):
    """Clicks and purchases of a user at most an hour apart."""
    events = table(spark, sf_dir, "events")
    clicks = (events.filter(F.col("event_type") == "click")
              .select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts")))
    purchases = (events.filter(F.col("event_type") == "purchase")
                 .select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")))
    return (joins.interval_join(clicks, purchases, ["user_id"], "click_ts", "purchase_ts", 3600)
            .select("click_id", "purchase_id", "user_id"))
