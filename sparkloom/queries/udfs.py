"""UDF queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions import udfs
from sparkloom.registry import query, table


@query("udf_plus_one", "select o_orderkey, o_custkey + 1 as next from orders")
def udf_plus_one(spark, sf_dir):
    """A user function on whole Arrow arrays, where the feature is the function; in real work `o_custkey + 1` is it."""
    return table(spark, sf_dir, "orders").select("o_orderkey", udfs.plus_one("o_custkey").alias("next"))


@query("udf_safe_divide", """
    select event_id, case when event_id % 3 = 0 then null else cast(2 // (event_id % 3) as bigint) end as by_udf,
           case when event_id % 3 = 0 then null else cast(2 // (event_id % 3) as bigint) end as by_expr
    from events""")
def udf_safe_divide(spark, sf_dir):
    """Division by zero gives null, as a total UDF and as an expression."""
    x = F.col("event_id") % 3
    return table(spark, sf_dir, "events").select("event_id", udfs.divide_two_by(x).alias("by_udf"),
                                                 udfs.safe_divide_two_by(x).alias("by_expr"))


@query("udf_null_guard", """
    with e as (select event_id, nullif(event_type, 'error') as kind from events)
    select event_id, concat(coalesce(kind, 'None'), ':', event_id) as called_with_null,
           case when kind is not null then concat(kind, ':', event_id) end as guarded
    from e""")
def udf_null_guard(spark, sf_dir):
    """A UDF sees nulls unless it is guarded."""
    kind = F.expr("nullif(event_type, 'error')")
    return table(spark, sf_dir, "events").select(
        "event_id", udfs.describe_pair(kind, F.col("event_id")).alias("called_with_null"),
        udfs.describe_guarded(kind, F.col("event_id")).alias("guarded"))


@query("udf_struct", """
    select p_partkey, cast(p_size as bigint) as first, cast(p_size * p_size as bigint) as second,
           cast(p_size * p_size * p_size as bigint) as third
    from part""")
def udf_struct(spark, sf_dir):
    """A struct result expanded by fields, evaluated once per row."""
    return (table(spark, sf_dir, "part")
            .select("p_partkey", udfs.powers_once(F.col("p_size").cast("bigint")).alias("res"))
            .select("p_partkey", "res.*"))
