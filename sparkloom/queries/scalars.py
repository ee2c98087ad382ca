"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions import schema as schemas
from sparkloom.functions.timestamps import as_ntz, floor_to
from sparkloom.registry import query, table


@query("fn_string", """
    select p_partkey, upper(p_name) as upper_name, lower(p_brand) as lower_brand,
           length(p_name) + 1 as len_next, trim(concat('  ', p_type, ' ')) as trimmed,
           regexp_replace(p_brand, '[0-9]', '', 'g') as letters, concat(p_brand, '/', p_type) as joined
    from part""")
def fn_string(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.upper("p_name").alias("upper_name"), F.lower("p_brand").alias("lower_brand"),
        (F.length("p_name").cast("bigint") + 1).alias("len_next"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("trimmed"),
        F.regexp_replace("p_brand", "[0-9]", "").alias("letters"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"))


@query("fn_split_char", """
    select p_partkey, string_split(p_name, '')[3] as third, string_split(p_name, ' ')[1] as first_word,
           string_split(p_name, ' ')[9] as ninth_word, cast(len(string_split(p_name, ' ')) as int) as n_words
    from part""")
def fn_split_char(spark, sf_dir):
    """Array positions out of range give null."""
    words = F.split("p_name", " ", -1)
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.get(F.split("p_name", ""), F.lit(2)).alias("third"), F.get(words, F.lit(0)).alias("first_word"),
        F.get(words, F.lit(8)).alias("ninth_word"), F.size(words).alias("n_words"))


@query("fn_explode", """
    select conv_id, turn, unnest(string_split(text, chr(10))) as line from conversations""")
def fn_explode(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.explode(F.split("text", "\n", -1)).alias("line"))


@query("fn_pmod", """
    select o_orderkey, cast((o_orderkey - 700) % 10 as bigint) as rem,
           cast((((o_orderkey - 700) % 10) + 10) % 10 as bigint) as pmod_fn,
           cast((((o_orderkey - 700) % 10) + 10) % 10 as bigint) as pmod_sql
    from orders""")
def fn_pmod(spark, sf_dir):
    """pmod stays positive where % keeps the sign."""
    x = F.col("o_orderkey") - 700
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", (x % 10).alias("rem"), F.pmod(x, F.lit(10)).alias("pmod_fn"),
        F.expr("pmod(o_orderkey - 700, 10)").alias("pmod_sql"))


@query("fn_cast", """
    select o_orderkey, cast(o_orderkey as varchar) as as_string, cast(o_custkey as int) as as_int,
           cast(null as int) as bad_int,
           cast(cast(o_totalprice as decimal(10,2)) as varchar) as as_decimal,
           cast(o_custkey as float) as as_float, cast(floor(o_totalprice) as bigint) as as_long,
           o_orderdate as as_timestamp, cast(o_orderdate as date) as as_date
    from orders""")
def fn_cast(spark, sf_dir):
    """A value that cannot be cast becomes null."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("as_string"),
        F.col("o_custkey").cast("string").try_cast("int").alias("as_int"),
        F.col("o_orderpriority").try_cast("int").alias("bad_int"),
        F.col("o_totalprice").try_cast("decimal(10,2)").cast("string").alias("as_decimal"),
        F.col("o_custkey").cast("float").alias("as_float"),
        F.col("o_totalprice").cast("long").alias("as_long"),
        F.col("o_orderdate").cast("string").try_cast("timestamp_ntz").alias("as_timestamp"),
        F.col("o_orderdate").cast("date").alias("as_date"))


@query("json_parse_props", """
    select event_id, cast(json_extract(props, '$.k') as bigint) as k from events""")
def json_parse_props(spark, sf_dir):
    return (table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint").alias("s"))
            .select("event_id", "s.*"))


@query("schema_of_json", """
    select event_id, 'STRUCT<k: BIGINT>' as ddl, cast(json_extract(props, '$.k') as bigint) as k from events""")
def schema_of_json(spark, sf_dir):
    """The schema of all values, used to parse the whole column."""
    events = table(spark, sf_dir, "events")
    ddl = schemas.infer_json_schema(events, "props")
    return (events.select("event_id", F.lit(ddl).alias("ddl"), F.from_json("props", F.lit(ddl)).alias("s"))
            .select("event_id", "ddl", "s.k"))


@query("schema_struct_cast", """
    select p_partkey, p_brand as brand, cast(p_size as varchar) as size_text from part""")
def schema_struct_cast(spark, sf_dir):
    """A struct cast renames and retypes by position."""
    return (table(spark, sf_dir, "part").select("p_partkey", F.struct("p_brand", "p_size").alias("s"))
            .select("p_partkey", F.col("s").cast("struct<brand: string, size_text: string>").alias("s"))
            .select("p_partkey", "s.*"))


@query("schema_upper", """
    select p_partkey as "P_PARTKEY", p_brand as "P_BRAND", p_size as "SIZE", p_type as "TYPE" from part""")
def schema_upper(spark, sf_dir):
    """All names upper-cased, nested ones too."""
    nested = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand",
        F.struct(F.col("p_size").alias("size"), F.array(F.struct(F.col("p_type").alias("type"))).alias("types"))
        .alias("boo"))
    return schemas.upper_names(nested).select("P_PARTKEY", "P_BRAND", "BOO.SIZE",
                                              F.col("BOO.TYPES")[0]["TYPE"].alias("TYPE"))


@query("schema_conform", """
    select p_partkey, cast(p_size as bigint) as p_size, cast(null as double) as weight, p_type,
           cast(null as varchar) as origin, p_brand
    from part""")
def schema_conform(spark, sf_dir):
    """Another order of columns, wider numbers, absent fields as nulls, inside a struct too; the rest is dropped."""
    part = table(spark, sf_dir, "part").select("p_brand", "p_size", F.struct("p_brand", "p_type", "p_name").alias("kind"),
                                               "p_partkey", "p_retailprice")
    target = "p_partkey bigint, p_size bigint, weight double, kind struct<p_type: string, origin: string, p_brand: string>"
    return schemas.conform(part, target).select("p_partkey", "p_size", "weight", "kind.*")


@query("fn_array_pick", """
    select event_id, list_value('north', 'east', 'south', 'west')[1 + event_id % 4] as side from events""")
def fn_array_pick(spark, sf_dir):
    """A repeatable pick from an array of literals."""
    sides = F.array(*[F.lit(x) for x in ("north", "east", "south", "west")])
    return table(spark, sf_dir, "events").select(
        "event_id", F.get(sides, F.pmod("event_id", F.lit(4)).cast("int")).alias("side"))


@query("fn_dates", """
    select event_id, cast(ts as date) - 1 as day_before, cast(ts as date) as day,
           strftime(ts, '%Y-%m') as month, strftime(ts, '%d.%m.%Y %H:%M') as text,
           to_timestamp_ntz as from_epoch
    from (select *, make_timestamp(1675167853000000 + event_id * 1000000) as to_timestamp_ntz from events)""")
def fn_dates(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_sub("ts", 1).alias("day_before"), F.to_date("ts").alias("day"),
        F.date_format("ts", "yyyy-MM").alias("month"), F.date_format("ts", "dd.MM.yyyy HH:mm").alias("text"),
        as_ntz((F.lit(1675167853) + F.col("event_id")).cast("timestamp")).alias("from_epoch"))


@query("fn_ts_floor", """
    select event_id, date_trunc('minute', ts) as minute, date_trunc('hour', ts) as hour,
           date_trunc('minute', ts) as minute_by_division
    from events""")
def fn_ts_floor(spark, sf_dir):
    """Floor by date_trunc and by dividing epoch seconds."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", as_ntz(floor_to("ts", "minute")).alias("minute"), as_ntz(floor_to("ts", "hour")).alias("hour"),
        as_ntz((F.floor(seconds / 60) * 60).cast("timestamp")).alias("minute_by_division"))


@query("win_tumbling_static", """
    select time_bucket(interval '10 minutes', ts) as window_start, event_type, count(*) as n
    from events group by 1, 2""")
def win_tumbling_static(spark, sf_dir):
    return (table(spark, sf_dir, "events").groupBy(F.window("ts", "10 minutes").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), "event_type", "n"))


@query("win_sliding_static", """
    select window_start, count(*) as n
    from (select time_bucket(interval '5 minutes', ts) as window_start from events
          union all select time_bucket(interval '5 minutes', ts) - interval '5 minutes' from events)
    group by window_start""")
def win_sliding_static(spark, sf_dir):
    """Ten-minute windows every five minutes: each row counts twice."""
    return (table(spark, sf_dir, "events").groupBy(F.window("ts", "10 minutes", "5 minutes").alias("w"))
            .agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "n"))


@query("fn_nulls", """
    with e as (select event_id, user_id, nullif(event_type, 'error') as kind from events)
    select event_id, kind, user_id + cast(case when kind is null then null else 1 end as bigint) as sum_null,
           kind is null as is_null, coalesce(kind <> 'click', false) as kept_by_not_equal
    from e""")
def fn_nulls(spark, sf_dir):
    """x + null is null; a comparison with null is neither true nor false."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id",
                                                   F.expr("nullif(event_type, 'error')").alias("kind"))
    one = F.when(F.col("kind").isNotNull(), F.lit(1).cast("bigint"))
    return events.select("event_id", "kind", (F.col("user_id") + one).alias("sum_null"),
                         F.col("kind").isNull().alias("is_null"),
                         F.coalesce(F.col("kind") != "click", F.lit(False)).alias("kept_by_not_equal"))
