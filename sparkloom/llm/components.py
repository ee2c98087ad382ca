"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so no task holds the neighbours of a node together, and the
edges of each round are written to the shared folder. The number of rounds grows with the logarithm of the
longest path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.scratch import freeze


def _with_minimum(directed: DataFrame) -> DataFrame:
    """For each (u, v): (u, v, least neighbour or self of u).

    The minima are written first, so that the join can split the edges of a node with very many.
    """
    least = freeze(directed.sparkSession,
                   directed.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    return directed.join(least, "u")


def _pairs(*ends: tuple[str, str]) -> Column:
    return F.inline(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ends]))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and one with a smaller neighbour has no larger one."""
    sides = edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))))
    return (sides.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
            .filter("below > 1 or below = 1 and above = 1").isEmpty())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node of an edge with the smallest node reachable from it.

    Repeated edges, loops and both directions may occur; edges with a null end are ignored. A node with
    loops only is its own component. No edges give no rows.
    """
    spark = edges.sparkSession
    ends = (edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null")
            .select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")))
    alone = ends.filter("u = v").select(F.col("u").alias("node")).distinct()
    now = freeze(spark, ends.filter("u <> v").distinct(), "edges")
    # Edges are written without repeats. In between, an edge gives one row in the large step, two in the small one.
    while not _is_stars(now):
        both = now.select(_pairs(("u", "v"), ("v", "u")))
        large = freeze(spark, _with_minimum(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        # u > v here: u's smaller neighbours and u itself point at the least of them.
        star = _with_minimum(large).select(_pairs(("v", "m"), ("u", "m"))).filter("u <> v").distinct()
        now = freeze(spark, star, "edges")
    found = (now.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.col("v").alias("component")),
        F.struct(F.col("v").alias("node"), F.col("v").alias("component")))))
             .unionByName(alone.select("node", F.col("node").alias("component"))))
    return found.groupBy("node").agg(F.min("component").alias("component"))
