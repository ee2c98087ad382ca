"""Stateful stream operators: aggregation, de-duplication, joins, with watermarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.timestamps import floor_to


def dedup(stream: DataFrame, keys: Sequence[str], salt_on: Sequence[str] = (), salts: int = 8) -> DataFrame:
    """One row per key. Without a watermark the state keeps every key for ever.

    A stream cannot drop duplicates before its shuffle, so all rows of a hot key would meet in one task.
    With `salt_on` they are first de-duplicated per (key, salt), which spreads them, and then per key,
    where at most `salts` rows of a key are left.
    """
    if salt_on:
        salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int")
        stream = stream.withColumn("__salt", salt).dropDuplicates([*keys, "__salt"]).drop("__salt")
    return stream.dropDuplicates(list(keys))


def dedup_with_watermark(stream: DataFrame, keys: Sequence[str], ts: str, delay: str,
                         salt_on: Sequence[str] = (), salts: int = 8) -> DataFrame:
    """Keys include the event time; late rows are dropped and old keys leave the state."""
    return dedup(stream.withWatermark(ts, delay), [*keys, ts], salt_on, salts)


def dedup_within(stream: DataFrame, keys: Sequence[str], ts: str, unit: str, delay: str,
                 salt_on: Sequence[str] = (), salts: int = 8) -> DataFrame:
    """One row per key and minute, hour or day of the event time."""
    return dedup_with_watermark(stream.withColumn(ts, floor_to(ts, unit)), keys, ts, delay, salt_on, salts)


def dedup_within_watermark(stream: DataFrame, keys: Sequence[str], ts: str, delay: str,
                           salt_on: Sequence[str] = (), salts: int = 8) -> DataFrame:
    """One row per key among rows whose event times lie within `delay` of the first one seen.

    Unlike `dedup_with_watermark` the time is no part of the key, so repeats that come with another time are dropped
    too, and the state keeps a key only until the watermark has passed its first row's time plus the delay: a key
    that comes back after that counts again. Late rows are dropped. `salt_on` spreads hot keys as in `dedup`.
    """
    stream = stream.withWatermark(ts, delay)
    if salt_on:
        salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int")
        stream = stream.withColumn("__salt", salt).dropDuplicatesWithinWatermark([*keys, "__salt"]).drop("__salt")
    return stream.dropDuplicatesWithinWatermark(list(keys))


def count_by_floor(stream: DataFrame, keys: Sequence[str], ts: str, unit: str, delay: str) -> DataFrame:
    """Counts per key and floored event time, with a watermark on the floored column."""
    return (stream.withColumn(ts, floor_to(ts, unit)).withWatermark(ts, delay)
                  .groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("n")))


def windowed(stream: DataFrame, keys: Sequence[str], ts: str, width: str, delay: str, *aggregates: Column,
             slide: str | None = None) -> DataFrame:
    """Aggregates per key and event-time window, flattened to window_start and window_end."""
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    result = stream.withWatermark(ts, delay).groupBy(*keys, span.alias("w")).agg(*aggregates)
    values = [c for c in result.columns if c not in ("w", *keys)]
    return result.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         *values)


def _salted_sides(left: DataFrame, right: DataFrame, salt_on: Sequence[str], salts: int):
    """Left rows spread by a hash, right rows repeated for every salt."""
    spread = left.withColumn("left_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    repeated = right.withColumn("right_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread, repeated


def join_same_window(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, width: str,
                     left_delay: str, right_delay: str, salt_on: Sequence[str] = (), salts: int = 1) -> DataFrame:
    """Stream-stream inner join on key and event-time window.

    Both sides need the same window width; their watermarks may differ. The window is part of the
    equi key, so a hot key is spread over its windows; with salts > 1 the left rows of one window are
    spread further by a hash of `salt_on`, at the price of `salts` copies of the right rows.
    """
    lw = left.withWatermark(left_ts, left_delay).withColumn("w", F.window(left_ts, width))
    rw = right.withWatermark(right_ts, right_delay).withColumn("w", F.window(right_ts, width))
    if salts <= 1:
        return lw.join(rw, [key, "w"], "inner")
    lw, rw = _salted_sides(lw, rw, salt_on, salts)
    return lw.join(rw.withColumnRenamed("right_salt", "left_salt"), [key, "w", "left_salt"], "inner").drop("left_salt")


def join_interval(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, seconds: int,
                  left_delay: str, right_delay: str, salt_on: Sequence[str] = (), salts: int = 1) -> DataFrame:
    """Stream-stream inner join: equal keys and event times at most `seconds` apart, both ways.

    The bound both ways lets both states be cleaned. A time bucket of four times the bound is added to the
    equi key. A right row is stored in the buckets that its bound reaches, one and a half on average, so a
    hot key is spread over time and rows are compared with near ones only; salts > 1 spread it further, as
    in `join_same_window`. The two frames may share only the key column.
    """
    def bucket(ts: str, shift: int = 0) -> Column:
        return F.floor((F.unix_seconds(ts) + F.lit(shift)) / F.lit(4 * seconds))

    lb = left.withColumn("left_bucket", bucket(left_ts)).withWatermark(left_ts, left_delay)
    # Left times have fractions of seconds; one second more on either side keeps whole seconds right.
    reached = F.sequence(bucket(right_ts, -seconds - 1), bucket(right_ts, seconds + 1))
    rb = (right.withWatermark(right_ts, right_delay).withColumn("right_bucket", F.explode(reached))
               .withColumnRenamed(key, "right_key"))
    bound = F.expr(f"interval {seconds} seconds")
    condition = ((F.col(key) == F.col("right_key")) & (F.col("left_bucket") == F.col("right_bucket"))
                 & (F.col(left_ts) <= F.col(right_ts) + bound)
                 & (F.col(left_ts) >= F.col(right_ts) - bound))
    if salts > 1:
        lb, rb = _salted_sides(lb, rb, salt_on, salts)
        condition = condition & (F.col("left_salt") == F.col("right_salt"))
    return (lb.join(rb, condition, "inner")
              .drop("left_bucket", "right_bucket", "right_key", "left_salt", "right_salt"))


def join_not_after(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, seconds: int,
                   left_delay: str, right_delay: str, salt_on: Sequence[str] = (), salts: int = 1) -> DataFrame:
    """Stream-stream inner join: equal keys, the left time at most `seconds` after the right one.

    Bounded on one side only: right rows leave the state once the left watermark has passed their bound, but
    left rows wait for later right rows as long as the query runs. Without a lower bound there is no time
    bucket; salts > 1 spread a hot key. The two frames may share only the key column.
    """
    lb = left.withWatermark(left_ts, left_delay)
    rb = right.withWatermark(right_ts, right_delay).withColumnRenamed(key, "right_key")
    condition = ((F.col(key) == F.col("right_key"))
                 & (F.col(left_ts) <= F.col(right_ts) + F.expr(f"interval {seconds} seconds")))
    if salts > 1:
        lb, rb = _salted_sides(lb, rb, salt_on, salts)
        condition = condition & (F.col("left_salt") == F.col("right_salt"))
    return lb.join(rb, condition, "inner").drop("right_key", "left_salt", "right_salt")


def enrich(stream: DataFrame, static: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stream-static left join: every stream row stays."""
    return stream.join(static, list(keys), "left")


def allow_only(stream: DataFrame, allowed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """White list: rows whose key is in the static table, once each."""
    return stream.join(allowed.select(*keys).distinct(), list(keys), "inner")


def block(stream: DataFrame, blocked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Black list: rows whose key is not in the static table."""
    return stream.join(blocked, list(keys), "left_anti")
