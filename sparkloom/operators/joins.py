"""Join operators: physical choices, null-safe keys, skew, theta joins, lookups."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.scratch import freeze

MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size, from file sizes and the plan; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the optimizer's estimate is within the bound; otherwise Spark chooses, and
    adaptive execution may still broadcast what turns out small."""
    return F.broadcast(df) if planned_bytes(df) <= max_bytes else df


def sort_merge_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    return left.join(right.hint("merge"), on, how)


def shuffle_hash_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    return left.join(right.hint("shuffle_hash"), on, how)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join where null equals null; hashable, unlike a UDF predicate.

    The left key columns are kept. The two frames may share only the key columns.
    """
    renamed = {k: f"__right_{k}" for k in keys}
    condition = functools.reduce(lambda a, b: a & b,
                                 [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()])
    joined = left.join(right.withColumnsRenamed(renamed), condition, how)
    return joined.drop(*renamed.values())


def _bounded(df: DataFrame, most_rows: int) -> DataFrame:
    """A written copy of the frame, so that its plan runs once; an error when it does not keep the bound that the
    caller declares for it."""
    df = freeze(df.sparkSession, df, "bounded")
    if df.count() > most_rows:
        raise ValueError(f"the side declared as bounded has more than {most_rows} rows")
    return df


def theta_join(left: DataFrame, right: DataFrame, condition: Column, most_right_rows: int) -> DataFrame:
    """Non-equi inner join. The caller declares how many rows the right side has at most; it is copied to
    every task, so the left side may have any size and is not shuffled."""
    return left.join(F.broadcast(_bounded(right, most_right_rows)), condition, "inner")


def cartesian(left: DataFrame, right: DataFrame, most_right_rows: int) -> DataFrame:
    """All pairs of a side of any size and one whose number of rows the caller bounds."""
    return left.crossJoin(_bounded(right, most_right_rows))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Keys with more than `hot_rows` rows, each with `__salts`: tasks that share it, hot_rows rows each.

    Without a number a key is hot when it has more rows than a shuffle partition would get if all were
    equal. There are fewer such keys than partitions, so the largest ones come to the driver, in one pass that also
    counts all rows. With a number they are written to the shared folder, at most rows / hot_rows of them.
    """
    spark = df.sparkSession
    if hot_rows is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        seen = Observation()
        counted = (df.select(*keys).observe(seen, F.count(F.lit(1)).alias("rows"))
                   .groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")))
        largest = counted.orderBy(F.desc("__n")).limit(partitions).collect()
        share = max(1, -(-(seen.get["rows"] if largest else 0) // partitions))
        schema = T.StructType([*df.select(*keys).schema.fields, T.StructField("__salts", T.IntegerType())])
        hot = [(*r[:-1], -(-r[-1] // share)) for r in largest if r[-1] > share]
        if not hot:  # an empty frame that the optimizer knows to be empty: joins with it vanish
            return df.select(*keys, F.lit(1).alias("__salts")).limit(0)
        return F.broadcast(spark.createDataFrame(hot, schema))
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
    return freeze(spark, counted.select(*keys, F.ceil(F.col("__n") / hot_rows).cast("int").alias("__salts")), "hot-keys")


def with_salt(df: DataFrame, hot: DataFrame, keys: Sequence[str], salt_on: Sequence[str]) -> DataFrame:
    """Column `__salt`: a hash of `salt_on` for rows of hot keys, 0 for all others.

    As the salt depends on the row only, a re-run task makes the same choice.
    """
    marked = null_safe_join(df, broadcast_if_small(hot), keys, "left")
    salt = F.pmod(F.xxhash64(*salt_on), F.coalesce("__salts", F.lit(1))).cast("int")
    return marked.withColumn("__salt", salt).drop("__salts")


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], salt_on: Sequence[str],
                how: str = "inner", hot_rows: int | None = None) -> DataFrame:
    """Equi join in which no key brings much more than `hot_rows` left rows (by default a partition's even
    share) to one task.

    Only the matches of hot keys are repeated, once per salt. `how` may be inner, left, left_semi or
    left_anti: every left row meets one copy of each match.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting the left side cannot do a {how} join")
    keys = list(keys)
    hot = hot_keys(left, keys, hot_rows)
    salts = F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)
    copies = (right.join(broadcast_if_small(hot), keys, "left")
                   .withColumn("__salt", F.explode(salts)).drop("__salts"))
    return with_salt(left, hot, keys, salt_on).join(copies, [*keys, "__salt"], how).drop("__salt")


def slice_bounds(df: DataFrame, column: str, slices: int) -> list:
    """Bounds that cut the rows into about equal slices: distinct approximate quantiles of the column."""
    shares = [i / slices for i in range(1, slices)]
    found = df.agg(F.percentile_approx(column, shares, 10_000).alias("b")).first()["b"]
    return sorted(set(found or []))


def sliced_join(left: DataFrame, right: DataFrame, keys: Sequence[str], slice_by: str,
                bounds: Sequence, how: str = "inner") -> DataFrame:
    """Join slice by slice on a column both sides share, then union all slices.

    Slices are (-inf, b0), [b0, b1), ..., [bn, inf) plus the null slice, so no row is lost.
    """
    def slice_filters(col: Column):
        edges = [None, *bounds, None]
        for low, high in zip(edges, edges[1:]):
            parts = [c for c in (None if low is None else col >= low,
                                 None if high is None else col < high) if c is not None]
            yield functools.reduce(lambda a, b: a & b, parts)
        yield col.isNull()

    joined = [left.filter(keep).join(right.filter(keep), [*keys], how)
              for keep in slice_filters(F.col(slice_by))]
    return functools.reduce(DataFrame.unionByName, joined)


def join_aggregate(df: DataFrame, aggregate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows joined to an aggregate of themselves, null keys included.

    The aggregate is written to the shared folder first. Its true size is then known when the join is
    planned: below the broadcast threshold the rows are not shuffled at all, above it the join is a
    shuffled one whose skewed partitions adaptive execution splits.
    """
    return null_safe_join(df, freeze(df.sparkSession, aggregate, "aggregate"), keys)


def with_group_count(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Each row with the size of its group: a pre-aggregated count joined back.

    Unlike `count(*) over (partition by k)`, no task ever holds a whole group.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return join_aggregate(df, counts, list(keys))


def prepartitioned_self_agg(df: DataFrame, key: str, partitions: int, salt_on: Sequence[str] = (),
                            hot_rows: int | None = None, name: str = "n") -> DataFrame:
    """Rows joined to their group count over one shared hash partitioning of the rows.

    The rows are shuffled once; the counting and the row side of the join both use that partitioning.
    With `salt_on`, hot keys, if there are any, are spread over several partitions and only the counts of the (key, salt)
    pairs, a few per hot key and one for any other, move again.
    """
    hot = hot_keys(df, [key], hot_rows) if salt_on else None
    if hot is None or hot.isEmpty():
        placed = df.repartition(partitions, key)
        counts = placed.groupBy(key).agg(F.count(F.lit(1)).alias(name))
        return placed.join(counts.hint("merge"), key)
    salted = (with_salt(df, hot, [key], salt_on)
              .repartition(partitions, key, "__salt"))
    partial = salted.groupBy(key, "__salt").agg(F.count(F.lit(1)).alias("__part"))
    per_salt = partial.select(key, "__salt", F.sum("__part").over(Window.partitionBy(key)).alias(name))
    return salted.join(per_salt.hint("merge"), [key, "__salt"]).drop("__salt")


def lookup_map(column: Column, mapping: Mapping) -> Column:
    """Value of a small driver-side map, null when the key is absent."""
    if not mapping:
        return F.lit(None)
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), column)


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                  seconds: int) -> DataFrame:
    """Pairs with equal keys and |left_ts - right_ts| <= seconds.

    Time buckets as wide as the bound join the key, so one key's rows are split over time instead of
    meeting in one task, and only rows of neighbouring buckets are compared. The two frames may share
    only the key columns.
    """
    width = F.lit(seconds)

    def bucket(ts: str) -> Column:
        return F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / width)

    left_b = left.withColumn("__bucket", bucket(left_ts))
    right_b = (right.withColumn("__own", bucket(right_ts))
                    .withColumn("__bucket", F.explode(F.array(*[F.col("__own") + i for i in (-1, 0, 1)])))
                    .drop("__own"))
    bound = F.expr(f"interval {seconds} seconds")
    near = (F.col(left_ts) <= F.col(right_ts) + bound) & (F.col(left_ts) >= F.col(right_ts) - bound)
    return left_b.join(right_b, [*keys, "__bucket"]).filter(near).drop("__bucket")
