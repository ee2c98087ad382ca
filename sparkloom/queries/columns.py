"""Projection, predicate and cleaning queries."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions.timestamps import in_month
from sparkloom.operators import clean
from sparkloom.registry import query, table

# Tables hold no nulls; these columns make them the same way on both sides.
NULLED = {"status": "nullif(o_orderstatus, 'P')",
          "priority": "nullif(o_orderpriority, '5-LOW')",
          "price": "case when o_totalprice >= 400000 then null else o_totalprice end"}
NULLED_SQL = """select o_orderkey, nullif(o_orderstatus, 'P') as status,
        nullif(o_orderpriority, '5-LOW') as priority,
        case when o_totalprice >= 400000 then null else o_totalprice end as price
    from orders"""


def nulled_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", *[F.expr(e).alias(n) for n, e in NULLED.items()])


@query("proj_select", """
    select *, upper(p_name) as name_upper, p_size + 1 as size_next, 'part' as kind from part""")
def proj_select(spark, sf_dir):
    return table(spark, sf_dir, "part").select("*", F.upper("p_name").name("name_upper"),
                                               (F.col("p_size") + 1).alias("size_next"),
                                               F.lit("part").alias("kind"))


@query("proj_struct", """
    select p_partkey, p_brand, p_type, p_size as size from part""")
def proj_struct(spark, sf_dir):
    """Build a struct, take one field by path and expand the rest."""
    nested = table(spark, sf_dir, "part").select(
        "p_partkey", F.struct("p_brand", "p_type").alias("names"), F.struct(F.col("p_size").alias("size")).alias("s"))
    return nested.select("p_partkey", "names.*", "s.size")


@query("proj_with_column", """
    select s_suppkey, s_name as name, s_nationkey, s_acctbal, length(s_name) + 1 as name_len,
           true as active, 42 as answer, cast(null as varchar) as note
    from supplier""")
def proj_with_column(spark, sf_dir):
    return (table(spark, sf_dir, "supplier")
            .withColumn("name_len", F.length("s_name").cast("bigint") + 1)
            .withColumnRenamed("s_name", "name")
            .withColumns({"active": F.lit(True), "answer": F.lit(42), "note": F.lit(None).cast("string")}))


@query("proj_drop", "select c_custkey, c_name, c_mktsegment from customer")
def proj_drop(spark, sf_dir):
    """Dropping a name that is not there changes nothing."""
    return table(spark, sf_dir, "customer").drop("c_nationkey", "c_acctbal", "no_such_column")


@query("filter_notations", """
    select notation, o_orderkey, o_totalprice
    from orders, (values ('attribute'), ('col'), ('string'), ('expr')) v(notation)
    where o_totalprice > 300000""")
def filter_notations(spark, sf_dir):
    """The same predicate in four notations, over one scan."""
    orders = table(spark, sf_dir, "orders")
    forms = {"attribute": orders.o_totalprice > 300000, "col": F.col("o_totalprice") > 300000,
             "string": F.expr("o_totalprice > 300000"), "expr": F.expr("o_totalprice") > F.lit(300000)}
    any_of = functools.reduce(lambda a, b: a | b, forms.values())
    named = F.explode(F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in forms.items()])))
    return orders.filter(any_of).select(named.alias("notation"), "o_orderkey", "o_totalprice")


@query("filter_bool", f"""
    select o_orderkey, status, price from ({NULLED_SQL})
    where (status <> 'F' and price > 100000) or priority in ('1-URGENT', '2-HIGH')""")
def filter_bool(spark, sf_dir):
    """and / or / isin / != / >; a null comparison keeps no row."""
    return (nulled_orders(spark, sf_dir)
            .filter(((F.col("status") != "F") & (F.col("price") > 100000))
                    | F.col("priority").isin("1-URGENT", "2-HIGH"))
            .select("o_orderkey", "status", "price"))


@query("filter_ts_between", """
    select event_id, ts from events
    where ts between timestamp '2024-01-10 06:00:00' and timestamp '2024-01-12 18:00:00'""")
def filter_ts_between(spark, sf_dir):
    return (table(spark, sf_dir, "events").select("event_id", "ts")
            .filter(F.col("ts").between(F.expr("timestamp_ntz'2024-01-10 06:00:00'"),
                                        F.expr("timestamp_ntz'2024-01-12 18:00:00'"))))


@query("filter_string", """
    select p_partkey, p_name from part
    where contains(p_name, 'ring') or starts_with(p_name, 'red')""")
def filter_string(spark, sf_dir):
    name = F.col("p_name")
    return (table(spark, sf_dir, "part").filter(name.contains("ring") | name.startswith("red"))
            .select("p_partkey", "p_name"))


@query("filter_year_month", """
    select o_orderkey, strftime(o_orderdate, '%Y-%m') as month from orders
    where strftime(o_orderdate, '%Y-%m') = '1997-02'""")
def filter_year_month(spark, sf_dir):
    """The month as a range on the stored column, so that it reaches the scan."""
    return (table(spark, sf_dir, "orders").filter(in_month("o_orderdate", 1997, 2))
            .select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")))


@query("na_drop", f"""
    select 'all' as how, o_orderkey from ({NULLED_SQL})
    where not (status is null and priority is null and price is null)
    union all
    select 'any' as how, o_orderkey from ({NULLED_SQL})
    where status is not null and priority is not null and price is not null""")
def na_drop(spark, sf_dir):
    """Rows that either form of the drop keeps, over one scan: `all` drops what `any` drops and less."""
    df, subset = nulled_orders(spark, sf_dir), list(NULLED)
    whole = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in subset])
    how = F.when(whole, F.array(F.lit("all"), F.lit("any"))).otherwise(F.array(F.lit("all")))
    return df.na.drop("all", subset=subset).select(F.explode(how).alias("how"), "o_orderkey")


@query("na_fill", f"""
    select o_orderkey, coalesce(status, 'Undefined') as status, priority, coalesce(price, 0) as price
    from ({NULLED_SQL})""")
def na_fill(spark, sf_dir):
    """Only the named columns of a matching type are filled."""
    return nulled_orders(spark, sf_dir).na.fill({"status": "Undefined", "price": 0.0})


@query("na_replace", f"""
    select o_orderkey, case status when 'F' then 'Finished' when 'O' then 'Open' else status end as status
    from ({NULLED_SQL})""")
def na_replace(spark, sf_dir):
    return (nulled_orders(spark, sf_dir).select("o_orderkey", "status")
            .na.replace({"F": "Finished", "O": "Open"}, subset=["status"]))


@query("case_when", """
    select o_orderkey,
           case when o_totalprice > 300000 then 'high' when o_totalprice > 100000 then 'middle'
                else 'low' end as band,
           case when o_orderstatus = 'F' then 1 end as finished
    from orders""")
def case_when(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(price > 300000, "high").when(price > 100000, "middle").otherwise("low").alias("band"),
        F.when(F.col("o_orderstatus") == "F", 1).alias("finished"))


@query("dedup_keys", """
    select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice
    from (select *, row_number() over (partition by o_custkey, o_orderstatus
                                       order by o_totalprice, o_orderkey) as rn from orders)
    where rn = 1""")
def dedup_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                   "o_orderpriority", "o_totalprice")
    return clean.dedup_first(orders, ["o_custkey", "o_orderstatus"], ["o_totalprice", "o_orderkey"])


@query("clean_records", """
    with lines as (
        select c_custkey as id, c_mktsegment as segment, n_name as country, c_acctbal as balance,
               c_nationkey % 5 = 1 as no_segment, c_nationkey % 5 = 2 as no_balance, false as broken
        from customer join nation on c_nationkey = n_nationkey
        union all
        select c_custkey, c_mktsegment, n_name, c_acctbal, false, false, c_nationkey % 5 = 3
        from customer join nation on c_nationkey = n_nationkey),
    filled as (
        select id, case when no_segment then 'Undefined' else segment end as segment,
               case country when 'NATION_1' then 'First' else country end as country,
               case when no_balance then 0 else balance end as balance
        from lines where not broken)
    select id, segment, country, balance
    from (select *, row_number() over (partition by segment, country order by id, balance) as rn from filled)
    where rn = 1""")
def clean_records(spark, sf_dir):
    """Blocks of JSON lines: split, explode, parse, drop malformed, fill, replace, de-duplicate.

    Each block has a line with absent fields and a second line that is cut off for some nations.
    """
    source = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    kind = F.col("c_nationkey") % 5
    sparse = F.to_json(F.struct(
        F.col("c_custkey").alias("id"), F.col("n_name").alias("country"),
        F.when(kind != 1, F.col("c_mktsegment")).alias("segment"),
        F.when(kind != 2, F.col("c_acctbal")).alias("balance")))
    full = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("n_name").alias("country"),
                              F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")))
    cut = F.when(kind == 3, F.substring(full, F.lit(1), F.length(full) - 3)).otherwise(full)
    blocks = source.select(F.concat_ws("\n", sparse, cut).alias("block"))

    schema = T.StructType.fromDDL("id bigint, segment string, country string, balance double")
    rows = clean.keep_well_formed(clean.parse_json_blocks(blocks, "block", schema))
    rows = (rows.na.fill({"segment": "Undefined", "balance": 0.0})
                .na.replace({"NATION_1": "First"}, subset=["country"]))
    return clean.dedup_first(rows, ["segment", "country"], ["id", "balance"])


@query("parse_records", """
    select o_orderkey, o_orderstatus as status,
           case when o_orderpriority = '5-LOW' then null else o_totalprice end as price,
           case when o_orderstatus = 'P' then null else o_custkey end as custkey
    from orders where o_orderpriority <> '2-HIGH'""")
def parse_records(spark, sf_dir):
    """CSV lines with header lines, wrong field counts, padded fields and bad numbers."""
    price = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    customer = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_custkey").cast("string"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"),
                       F.concat(F.lit(' "'), F.col("o_orderstatus"), F.lit('" ')), price, customer)
    extra = F.when(F.col("o_orderpriority") == "2-HIGH", F.concat(line, F.lit(",surplus"))).otherwise(line)
    header = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("key,status,price,customer"), extra))
    lines = table(spark, sf_dir, "orders").select(
        F.explode(F.coalesce(header, F.array(extra))).alias("value"))

    body = clean.without_header(lines, "key,status,price,customer")
    body = body.withColumn("value", clean.strip_quotes(F.col("value")))
    schema = T.StructType.fromDDL("o_orderkey bigint, status string, price double, custkey bigint")
    return clean.parse_records(body, schema)
