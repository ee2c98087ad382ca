"""Aggregations beyond a plain groupBy: salted counts, shares, bounded lists, pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.joins import broadcast_if_small, join_aggregate, null_safe_join
from sparkloom.operators.positions import group_row_number
from sparkloom.scratch import freeze


def salted_count(df: DataFrame, key: str, salt_on: Sequence[str], salts: int = 10,
                 name: str = "n") -> DataFrame:
    """Two-stage count: by (key, salt), then by key. Equals the plain count.

    The salt is a hash of row columns rather than a random draw, so retried tasks agree.
    """
    salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int")
    first = df.groupBy(key, salt.alias("__salt")).agg(F.count(F.lit(1)).alias("__part"))
    return first.groupBy(key).agg(F.sum("__part").alias(name))


def share_of_group(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """(outer, inner) counts and their share of the outer count in basis points.

    The outer totals come from the already small inner counts, not from a second pass over the rows.
    """
    by_both = df.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("cnt_ab"))
    by_outer = by_both.groupBy(outer).agg(F.sum("cnt_ab").alias("cnt_a"))
    return (null_safe_join(by_both, by_outer, [outer])
            .withColumn("share_bp", F.expr("(10000 * cnt_ab) div cnt_a")))


def with_share_of_group(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Every row with its two group counts and the share: the distributed form of two count windows."""
    return join_aggregate(df, share_of_group(df, outer, inner), [outer, inner])


def collect_list_chunked(df: DataFrame, keys: list[str], value: str, order: list[str],
                         chunk_rows: int = 1000, long_rows: int = 100_000) -> DataFrame:
    """collect_list per key, ascending by `order`, in lists of at most `chunk_rows` values, nulls skipped.

    A key gives the rows `chunk` 0, 1, ... with n values each, only the last list being shorter; a key
    without a value gives one empty list. The rows of a key are counted first. Keys with up to `long_rows` are
    grouped and cut in one shuffle; those with more, at most rows / long_rows of them, have their rows numbered
    without gathering a key in one task, so a list is all that a task holds of such a key.
    """
    rows = df.select(*dict.fromkeys([*keys, *order, value]))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > long_rows)
    long_keys = freeze(df.sparkSession, sizes.select(*keys), "long-keys")
    if not long_keys.count():
        return _lists_of_short_keys(rows, keys, value, order, chunk_rows)
    long_keys = broadcast_if_small(long_keys)
    return (_lists_of_short_keys(null_safe_join(rows, long_keys, keys, "left_anti"), keys, value, order, chunk_rows)
            .unionByName(_lists_of_long_keys(null_safe_join(rows, long_keys, keys, "left_semi"), keys, value, order,
                                             chunk_rows)))


def _lists_of_short_keys(rows: DataFrame, keys: list[str], value: str, order: list[str], chunk_rows: int) -> DataFrame:
    """All values of a key in one sorted array, which is then cut."""
    item = F.struct(*[F.col(c).alias(f"__{i}") for i, c in enumerate(order)], F.col(value).alias("__value"))
    grouped = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(F.col(value).isNotNull(), item))).alias("__all"))
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("__all") / chunk_rows).cast("int") - 1, F.lit(0)))
    cut = F.transform(starts, lambda c: F.transform(F.slice("__all", c * chunk_rows + 1, chunk_rows),
                                                    lambda item: item["__value"]))
    return (grouped.select(*keys, F.posexplode(cut).alias("chunk", "items"))
            .select(*keys, "chunk", F.size("items").cast("long").alias("n"), "items"))


def _lists_of_long_keys(rows: DataFrame, keys: list[str], value: str, order: list[str], chunk_rows: int) -> DataFrame:
    rows = rows.withColumn("__none", F.col(value).isNull())
    placed = group_row_number(rows, keys, ["__none", *order], "__rn")
    placed = placed.withColumn("chunk", F.expr(f"cast((__rn - 1) div {chunk_rows} as int)"))
    items = F.sort_array(F.collect_list(F.when(~F.col("__none"), F.struct("__rn", F.col(value).alias("__value")))))
    return (placed.groupBy(*keys, "chunk").agg(F.transform(items, lambda item: item["__value"]).alias("items"))
            .withColumn("n", F.size("items").cast("long")).filter("n > 0 or chunk = 0")
            .select(*keys, "chunk", "n", "items"))


def distinct_values(df: DataFrame, column: str, most: int) -> list:
    """All values of a column, null last; more than `most` are an error, none is left out."""
    rows = df.select(column).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"column {column} has more than {most} values")
    return sorted((r[0] for r in rows), key=lambda v: (v is None, v))


def pivot_sum(df: DataFrame, key: str, column: str, measure: Column, values: Sequence | None = None,
              most_values: int = 1000) -> DataFrame:
    """Sums in a column per value; empty cells are null. The values are listed by a job unless they are
    given; rows with other values than given ones are an error, not lost."""
    if values is None:
        values = distinct_values(df, column, most_values)
    else:
        known = [v for v in values if v is not None]
        other = ~F.col(column).isin(known) if known else F.lit(True)
        if None not in values:
            other = other | F.col(column).isNull()
        df = df.withColumn(column, F.when(other, F.raise_error(F.lit(f"unlisted value in {column}")))
                           .otherwise(F.col(column)))
    return df.groupBy(key).pivot(column, list(values)).agg(F.sum(measure))


def letter_counts(df: DataFrame, text: str) -> DataFrame:
    """How often each character but blanks occurs, lower-cased.

    Each task counts its characters in a table as small as the alphabet, so next to nothing is shuffled.
    """
    letters = df.select(F.explode(F.split(F.lower(F.col(text)), "")).alias("letter"))
    return letters.groupBy("letter").agg(F.count(F.lit(1)).alias("n")).filter(F.trim("letter") != "")


def with_global_count(df: DataFrame, name: str = "n") -> DataFrame:
    """`count(*) over ()` as a scalar subquery: no single-partition window over the rows."""
    total = df.agg(F.count(F.lit(1)).alias(name))
    return df.withColumn(name, total.scalar())
