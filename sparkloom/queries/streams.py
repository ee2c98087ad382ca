"""Streaming queries: the whole events table arrives slice by slice, one slice per micro-batch."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from sparkloom import registry
from sparkloom.functions.timestamps import as_ntz
from sparkloom.queries.sources import EVENT_VALUE, event_topic
from sparkloom.registry import table
from sparkloom.scratch import new_dir, stage_once
from sparkloom.session import state_settings
from sparkloom.sources import connectors, inserts
from sparkloom.streaming import batch_writers, control, custom, runner, stateful, table_source
from sparkloom.streaming.staging import SLICES_SQL, Arrivals, slices_for, stage_arrivals, stream_arrivals

query = functools.partial(registry.query, settings=state_settings)

_arrivals: dict[str, Arrivals] = {}


def _staged(spark, sf_dir, label, df, ts, order, least_slices=None) -> Arrivals:
    made = {}

    def write(path):
        slices = None if least_slices is None else max(least_slices, slices_for(df.count()))
        made["arrivals"] = stage_arrivals(df, ts, path, slices, order=order)

    path = stage_once(spark, sf_dir, label, write)
    if made:
        _arrivals[path] = made["arrivals"]
    return _arrivals[path]


def event_stream(spark, sf_dir):
    """(event_id, ts, user_id, event_type, value, props), ts being an instant."""
    return stream_arrivals(spark, _staged(spark, sf_dir, "event-arrivals", table(spark, sf_dir, "events"), "ts",
                                        ["event_id"]))


@query("st_file_source", """
    select event_id, upper(event_type) as kind, ts from events where value > 10""")
def st_file_source(spark, sf_dir):
    """Declared schema, a slice of files per trigger, ordinary column work."""
    stream = (event_stream(spark, sf_dir).filter(F.col("value") > 10)
              .select("event_id", F.upper("event_type").alias("kind"), as_ntz("ts").alias("ts")))
    return runner.append_result(stream)


@query("st_parquet_sink", "select event_id, user_id, event_type, value from events")
def st_parquet_sink(spark, sf_dir):
    return runner.append_result(event_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "value"))


@query("st_foreach_batch", "select event_id, user_id, value from events")
def st_foreach_batch(spark, sf_dir):
    """Each micro-batch is a static frame; its writer replaces its own directory."""
    out = new_dir(spark, "foreach-batch")
    stream = event_stream(spark, sf_dir).select("event_id", "user_id", "value")
    runner.run_available(stream.writeStream.foreachBatch(runner.per_batch_writer(out)),
                         new_dir(spark, "checkpoint"))
    return spark.read.parquet(out).drop("batch_id")


@query("st_fanout", """
    select event_id, event_type, string_split(event_type, '')[3] as name from events""")
def st_fanout(spark, sf_dir):
    """One directory per category (third letter), and at the same time a second sink with all rows."""
    out, copy = new_dir(spark, "fanout"), new_dir(spark, "fanout-copy")
    stream = event_stream(spark, sf_dir).select("event_id", "event_type")
    writer = batch_writers.to_all([batch_writers.fan_out(out, batch_writers.third_letter("event_type")),
                                   runner.per_batch_writer(copy)])
    runner.run_available(stream.writeStream.foreachBatch(writer), new_dir(spark, "checkpoint"))
    return spark.read.parquet(out).select("event_id", "event_type", "name")


@query("st_agg_complete", """
    select event_type, count(*) as n, max(value) as highest from events group by event_type""")
def st_agg_complete(spark, sf_dir):
    stream = (event_stream(spark, sf_dir).groupBy("event_type")
              .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("highest")))
    return runner.complete_result(stream)


@query("st_agg_update", "select user_id, count(*) as n, max(event_id) as newest from events group by user_id")
def st_agg_update(spark, sf_dir):
    stream = (event_stream(spark, sf_dir).groupBy("user_id")
              .agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("newest")))
    return runner.update_result(stream, ["user_id"])


@query("st_agg_hour", """
    select event_type, date_trunc('hour', ts) as hour, count(*) as n from events group by 1, 2""")
def st_agg_hour(spark, sf_dir):
    """Counts per floored hour with a watermark of two hours, update mode."""
    counts = stateful.count_by_floor(event_stream(spark, sf_dir), ["event_type"], "ts", "hour", "2 hours")
    latest = runner.update_result(counts, ["event_type", "ts"])
    return latest.select("event_type", as_ntz("ts").alias("hour"), "n")


@query("st_agg_append", """
    select event_type, time_bucket(interval '1 hour', ts) as window_start, count(*) as n
    from events group by 1, 2
    having time_bucket(interval '1 hour', ts) + interval '1 hour'
           <= (select max(ts) from events) - interval '1 day'""")
def st_agg_append(spark, sf_dir):
    """Append mode gives a window once the watermark has passed its end."""
    counts = stateful.windowed(event_stream(spark, sf_dir), ["event_type"], "ts", "1 hour", "1 day",
                               F.count(F.lit(1)).alias("n"))
    return runner.append_result(counts.select("event_type", as_ntz("window_start").alias("window_start"), "n"))


@query("st_dedup", "select distinct user_id, event_type from events")
def st_dedup(spark, sf_dir):
    """A key's rows are de-duplicated in two steps, so a hot key is not one task's work."""
    unique = stateful.dedup(event_stream(spark, sf_dir), ["user_id", "event_type"], ["event_id"], salts=4)
    return runner.append_result(unique.select("user_id", "event_type"))


@query("st_dedup_wm", "select event_id, ts from events")
def st_dedup_wm(spark, sf_dir):
    """Every event is delivered twice and counted once."""
    once = event_stream(spark, sf_dir).select("event_id", "ts")
    twice = once.union(event_stream(spark, sf_dir).select("event_id", "ts"))
    result = stateful.dedup_with_watermark(twice, ["event_id"], "ts", "2 hours")
    return runner.append_result(result.select("event_id", as_ntz("ts").alias("ts")))


@query("st_dedup_within_watermark", """
    select event_id, unnest([0, 1]) as round from events where ts is not null""")
def st_dedup_within_watermark(spark, sf_dir):
    """Every event comes three times within twenty minutes, each time with another time, and counts once. Long after,
    when the state has let it go, it comes three times again and counts once more."""
    low, high = table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    far = 0 if low is None else int((high - low).total_seconds()) // 60 + 24 * 60
    shifts = F.array(*[F.struct(F.lit(r).alias("round"), F.lit(r * far + m).alias("minutes"))
                       for r in (0, 1) for m in (0, 10, 20)])
    echoes = (table(spark, sf_dir, "events").filter("ts is not null")
              .select("event_id", "ts", F.explode(shifts).alias("echo"))
              .select("event_id", "echo.round", (F.col("ts") + F.make_dt_interval(mins=F.col("echo.minutes"))).alias("ts")))
    staged = _staged(spark, sf_dir, "echo-arrivals", echoes, "ts", ["event_id"], least_slices=8)
    once = stateful.dedup_within_watermark(stream_arrivals(spark, staged), ["event_id"], "ts", "1 hour")
    return runner.append_result(once.select("event_id", "round"))


@query("st_dedup_minute", "select distinct event_type, date_trunc('minute', ts) as minute from events")
def st_dedup_minute(spark, sf_dir):
    stream = event_stream(spark, sf_dir).select("event_id", "event_type", "ts")
    result = stateful.dedup_within(stream, ["event_type"], "ts", "minute", "10 minutes", ["event_id"], salts=4)
    return runner.append_result(result.select("event_type", as_ntz("ts").alias("minute")))


@query("st_union_window", """
    with u as (select event_type, ts from events
               union all
               select event_type, cast(cast(ts as date) - 1 as timestamp) from events)
    select event_type, time_bucket(interval '1 hour', ts) as window_start, count(*) as n
    from u group by 1, 2""")
def st_union_window(spark, sf_dir):
    """Two streams, the second with times moved to the midnight before; none is late for this watermark."""
    events = event_stream(spark, sf_dir).select("event_type", "ts")
    older = event_stream(spark, sf_dir).select("event_type", F.date_sub("ts", 1))
    both = events.union(older).toDF("event_type", "ts")
    counts = stateful.windowed(both, ["event_type"], "ts", "1 hour", "10 days", F.count(F.lit(1)).alias("n"))
    latest = runner.update_result(counts.drop("window_end"), ["event_type", "window_start"])
    return latest.select("event_type", as_ntz("window_start").alias("window_start"), "n")


# Batch k is slice k of equal numbers of rows in the order of time. A row of batch k is judged by the watermark
# that the batches before k - 1 have set.
LATE_SQL = f"""
    with lim as (select (count(*) + {SLICES_SQL} - 1) // {SLICES_SQL} as per_slice from events),
    e as (select event_type,
                 case when event_type = 'error' then ts - interval 3 days else ts end as et,
                 (row_number() over (order by ts nulls last, event_id) - 1) // per_slice as batch
          from events, lim),
    peaks as (select batch, max(et) as peak from e group by batch),
    marks as (select b.batch, (select max(p.peak) from peaks p where p.batch < b.batch - 1)
                              - interval 1 day as mark
              from (select distinct batch from e) b)
    select event_type, time_bucket(interval '1 hour', et) as window_start, count(*) as n
    from e join marks using (batch)
    where mark is null or time_bucket(interval '1 hour', et) + interval '1 hour' > mark
    group by 1, 2"""


@query("st_late_data", LATE_SQL)
def st_late_data(spark, sf_dir):
    """Events of one type arrive three days late; those behind the watermark are dropped."""
    late = F.when(F.col("event_type") == "error", F.col("ts") - F.expr("interval 3 days")).otherwise(F.col("ts"))
    stream = event_stream(spark, sf_dir).select("event_type", late.alias("et"))
    counts = stateful.windowed(stream, ["event_type"], "et", "1 hour", "1 day", F.count(F.lit(1)).alias("n"))
    latest = runner.update_result(counts.drop("window_end"), ["event_type", "window_start"])
    return latest.select("event_type", as_ntz("window_start").alias("window_start"), "n")


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")


@query("st_join_left", """
    select event_id, user_id, c_name from events left join customer
    on user_id = c_custkey and c_mktsegment <> 'BUILDING'""")
def st_join_left(spark, sf_dir):
    """Enrichment: events of users that the static table lacks stay, with nulls."""
    static = _customers(spark, sf_dir).filter(F.col("c_mktsegment") != "BUILDING").drop("c_mktsegment")
    return runner.append_result(stateful.enrich(event_stream(spark, sf_dir).select("event_id", "user_id"),
                                                static, ["user_id"]).select("event_id", "user_id", "c_name"))


@query("st_join_whitelist", """
    select event_id, user_id from events
    where user_id in (select c_custkey from customer where c_mktsegment = 'MACHINERY')""")
def st_join_whitelist(spark, sf_dir):
    listed = _customers(spark, sf_dir).filter(F.col("c_mktsegment") == "MACHINERY")
    stream = event_stream(spark, sf_dir).select("event_id", "user_id")
    return runner.append_result(stateful.allow_only(stream, listed, ["user_id"]).select("event_id", "user_id"))


@query("st_join_blacklist", """
    select event_id, user_id from events
    where user_id not in (select c_custkey from customer where c_mktsegment = 'MACHINERY')""")
def st_join_blacklist(spark, sf_dir):
    listed = _customers(spark, sf_dir).filter(F.col("c_mktsegment") == "MACHINERY")
    stream = event_stream(spark, sf_dir).select("event_id", "user_id")
    return runner.append_result(stateful.block(stream, listed, ["user_id"]).select("event_id", "user_id"))


def _clicks(spark, sf_dir):
    return (event_stream(spark, sf_dir).filter(F.col("event_type") == "click")
            .select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts")))


def _purchases(spark, sf_dir):
    return (event_stream(spark, sf_dir).filter(F.col("event_type") == "purchase")
            .select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")))


@query("st_join_window", """
    select l.event_id as click_id, r.event_id as purchase_id, l.user_id
    from events l join events r
      on l.user_id = r.user_id
     and time_bucket(interval '1 hour', l.ts) = time_bucket(interval '1 hour', r.ts)
    where l.event_type = 'click' and r.event_type = 'purchase'""")
def st_join_window(spark, sf_dir):
    """Two streams on user and hour, with watermarks of two and three hours."""
    pairs = stateful.join_same_window(_clicks(spark, sf_dir), _purchases(spark, sf_dir), "user_id", "click_ts",
                                      "purchase_ts", "1 hour", "2 hours", "3 hours", ["click_id"], salts=2)
    return runner.append_result(pairs.select("click_id", "purchase_id", "user_id"))


@query("st_join_interval", """
    select l.event_id as click_id, r.event_id as purchase_id, l.user_id
    from events l join events r on l.user_id = r.user_id
    where l.event_type = 'click' and r.event_type = 'purchase'
      and l.ts <= r.ts + interval 1 hour and l.ts >= r.ts - interval 1 hour""")
def st_join_interval(spark, sf_dir):
    """Two streams, times at most an hour apart either way."""
    pairs = stateful.join_interval(_clicks(spark, sf_dir), _purchases(spark, sf_dir), "user_id", "click_ts",
                                   "purchase_ts", 3600, "2 hours", "3 hours")
    return runner.append_result(pairs.select("click_id", "purchase_id", "user_id"))


@query("st_join_interval_onesided", """
    select l.event_id as click_id, r.event_id as purchase_id, l.user_id
    from events l join events r on l.user_id = r.user_id
    where l.event_type = 'click' and r.event_type = 'purchase' and l.ts <= r.ts + interval 1 hour""")
def st_join_interval_onesided(spark, sf_dir):
    """Two streams, the click at most an hour after the purchase, and before it by any time."""
    pairs = stateful.join_not_after(_clicks(spark, sf_dir), _purchases(spark, sf_dir), "user_id", "click_ts",
                                    "purchase_ts", 3600, "2 hours", "3 hours")
    return runner.append_result(pairs.select("click_id", "purchase_id", "user_id"))


@query("st_render_inserts", """
    select concat('INSERT INTO TABLE foo (event_id, ts, event_type) VALUE (', event_id, 'L, ts:',
                  epoch_us(ts), ', ''', event_type, ''')') as statement
    from events""")
def st_render_inserts(spark, sf_dir):
    """Each micro-batch as INSERT statements through the custom sink."""
    out = new_dir(spark, "statements")
    stream = inserts.render_inserts(event_stream(spark, sf_dir).select("event_id", "ts", "event_type"), "foo")
    runner.run_available(custom.write_statements(stream, out), new_dir(spark, "checkpoint"))
    return custom.committed_statements(spark, out)


@query("st_kafka_decode", """
    select 'events' as topic, cast(event_id % 4 as int) as "partition", event_id, user_id, event_type, value
    from events""")
def st_kafka_decode(spark, sf_dir):
    """Records of a stored topic as a stream; JSON values become columns."""
    topic = _staged(spark, sf_dir, "topic-arrivals", event_topic(spark, sf_dir), "timestamp", ["partition", "offset"])
    return runner.append_result(connectors.kafka_decode(stream_arrivals(spark, topic), EVENT_VALUE).drop("offset"))


@query("st_custom_source", "select event_id, ts, user_id, event_type, value from events")
def st_custom_source(spark, sf_dir):
    """The stored table read by a source of our own, a bounded number of rows per micro-batch and per task."""
    rows = table(spark, sf_dir, "events").count()
    per_batch = max(1, -(-rows // slices_for(rows)))
    stream = table_source.stream_table(spark, f"{sf_dir}/events.parquet", new_dir(spark, "offsets"), per_batch,
                                       max(1, -(-per_batch // spark.sparkContext.defaultParallelism)),
                                       table(spark, sf_dir, "events").schema)
    out = new_dir(spark, "from-source")
    runner.start_empty(stream, out)
    runner.run_until_drained(stream.writeStream.format("parquet").option("path", out), new_dir(spark, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(out).select("event_id", "ts", "user_id", "event_type", "value")


@query("st_restart", "select event_id, user_id, event_type from events")
def st_restart(spark, sf_dir):
    """A query that ends, and is started again on more input that also repeats the old: each event counts once, as
    the second run has the state of the first."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    incoming, out, checkpoint = (new_dir(spark, name) for name in ("incoming", "restarted", "checkpoint"))
    runner.start_empty(events, out)
    for part in (events.filter("event_id % 2 = 0"), events):
        part.write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(events.schema).parquet(incoming)
        runner.append_more(stateful.dedup(stream, ["event_id"]), out, checkpoint)
    return spark.read.schema(events.schema).parquet(out)


@query("st_progress", f"""
    with lim as (select (count(*) + {SLICES_SQL} - 1) // {SLICES_SQL} as per_slice from events),
    e as (select user_id, (row_number() over (order by ts nulls last, event_id) - 1) // per_slice as batch_id
          from events, lim),
    first_seen as (select user_id, min(batch_id) as batch_id from e group by user_id),
    sizes as (select batch_id, count(*) as input_rows from e group by batch_id)
    select batch_id, input_rows, (select count(*) from first_seen f where f.batch_id <= s.batch_id) as state_rows
    from sizes s""")
def st_progress(spark, sf_dir):
    """The record of a running count by user as a table: rows of each micro-batch, and users known after it."""
    log = control.ProgressTable(spark, new_dir(spark, "progress"))
    spark.streams.addListener(log)
    try:
        counts = event_stream(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
        writer = counts.writeStream.outputMode("update").foreachBatch(runner.per_batch_writer(new_dir(spark, "counts")))
        log.wait(runner.run_available(writer, new_dir(spark, "checkpoint")))
    finally:
        spark.streams.removeListener(log)
    return log.table().filter("input_rows > 0").select("batch_id", "input_rows", "state_rows")
