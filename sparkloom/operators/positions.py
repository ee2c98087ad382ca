"""Row numbers that never put a whole table, or a whole hot key, into one task.

`row_number() over (order by x)` moves everything to a single partition, and
`row_number() over (partition by k order by x)` moves a hot key to a single task. Here rows are range
partitioned by the full order (which also splits a hot key), numbered inside each partition, and
shifted by the sizes of the earlier partitions. The numbering is frozen in the shared folder before
it is used twice, so lost executors cannot change it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators.joins import join_aggregate
from sparkloom.scratch import freeze

_LOCAL = "__row_in_partition"
_PART = "__partition"

# monotonically_increasing_id: partition number in the upper bits, row number in the lower 33 bits.
_LOCAL_BITS = 33


def global_row_number(df: DataFrame, order: list[Column | str], name: str = "rn", ranges: int | None = None) -> DataFrame:
    """Number all rows from 1 in the given order, which should be total to be repeatable; in the session's number of
    partitions or in `ranges`."""
    ranged = (df.repartitionByRange(*([ranges] if ranges else []), *order)
                .sortWithinPartitions(*order)
                .withColumn(_LOCAL, F.monotonically_increasing_id()))
    frozen = freeze(df.sparkSession, ranged, "row-number")
    numbered = (frozen.withColumn(_PART, F.shiftright(_LOCAL, _LOCAL_BITS))
                      .withColumn(_LOCAL, F.col(_LOCAL).bitwiseAND((1 << _LOCAL_BITS) - 1)))
    # One row per range partition (spark.sql.shuffle.partitions of them), so the unpartitioned window
    # below is small and so is the broadcast.
    sizes = numbered.groupBy(_PART).agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PART, F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset"))
    return (numbered.join(F.broadcast(offsets), _PART)
                    .withColumn(name, F.col("__offset") + F.col(_LOCAL) + 1)
                    .drop(_PART, _LOCAL, "__offset"))


def group_row_number(df: DataFrame, keys: list[str], order: list[Column | str],
                     name: str = "rn") -> DataFrame:
    """Number the rows of each key from 1: position in the whole order minus the key's first one."""
    placed = global_row_number(df, [*keys, *order], "__position")
    first = placed.groupBy(*keys).agg(F.min("__position").alias("__first"))
    return (join_aggregate(placed, first, keys)
            .withColumn(name, F.col("__position") - F.col("__first") + 1)
            .select(*df.columns, name))
