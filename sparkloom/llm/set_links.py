"""Links between sets of 64-bit hashes, by exact comparison of candidates, for clusters of any size.

A table of sets has (node, shingles): sorted distinct hashes as bytes. Two sets link where 100 * intersection >=
percent * union. What is returned are enough links (x, y) to connect all nodes that are connected by links.

`links_within` compares all sets of a unit. `star_links` is for units that are too large for that. It looks at pairs
that meet in a bucket only, and at as few of them as it can:

1. Each node is compared with the one node it is tied to in most buckets. Linked nodes make stars; the star's radius
   is the greatest Jaccard distance of a member to the center.
2. In buckets, members give way to their centers. Buckets with the same centers are one, buckets with one center are
   settled. The centers of a bucket are compared.
3. Jaccard distance is a metric, so members of two stars can only link where the distance of the centers is at most
   1 - percent / 100 plus both radii. Of such stars that are not connected yet, the members that can reach the other
   star are compared.

Two bits of chance remain, both without loss: buckets are taken for the same by 128 bits and their size, and units of
the last step may fall together, which compares more. No tables or no nodes give no rows. A node that is there twice
links with itself, which changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import in_parts
from sparkloom.llm.components import connected_components
from sparkloom.scratch import freeze

_SLACK = 1e-9


def block_forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """(i, j) edges of a spanning forest of the links among the sets; exact integer comparison.

    Grows each component from a first member: each member is compared with all sets not yet reached, by one
    pass over their shingles.
    """
    edges: list[tuple[int, int]] = []
    if len(sets) < 2:
        return edges
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(codes, np.cumsum(sizes)[:-1])
    marks = np.zeros(int(codes.max()) + 1, np.int32)
    left = np.arange(len(sets))
    flat, starts = codes, np.cumsum(sizes) - sizes
    alive = np.ones(len(sets), bool)
    queue: list[int] = []
    dirty = 0
    while alive.any():
        if not queue:
            queue = [int(np.flatnonzero(alive)[0])]
            alive[queue[0]] = False
        pivot = queue.pop()
        dirty += 1
        if dirty == 1 or alive.sum() * 2 < len(left):  # keep only what is left to reach
            left = np.flatnonzero(alive)
            if not len(left):
                break
            flat = np.concatenate([own[k] for k in left])
            starts = np.cumsum(sizes[left]) - sizes[left]
        marks[own[pivot]] = 1
        common = np.add.reduceat(marks[flat], starts)
        marks[own[pivot]] = 0
        union = sizes[left] + sizes[pivot] - common
        for k in left[alive[left] & (100 * common >= percent * union)]:
            alive[k] = False
            queue.append(int(k))
            edges.append((pivot, int(k)))
    return edges


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(b, a)
    inside = at < len(b)
    return int((b[at[inside]] == a[inside]).sum())


def _shared_and_all(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and of the union."""
    common = overlap(a, b)
    return common, len(a) + len(b) - common


def units_of(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], keyed: bool = False) -> Iterator:
    """The rows of one (unit, part) at a time, of batches sorted by them; the last column as hashes. With `keyed`, the
    unit is given before its rows."""
    key, held = None, []
    for batch in in_parts(batches):
        for row in zip(*(batch.column(c).to_pylist() for c in ("unit", "part", *columns))):
            if row[:2] != key:
                if held:
                    yield (key[0], held) if keyed else held
                key, held = row[:2], []
            held.append((*row[2:-1], np.frombuffer(row[-1], np.uint64)))
    if held:
        yield (key[0], held) if keyed else held


def link_batch(rows: list[tuple], *kinds: pa.DataType) -> Iterator[pa.RecordBatch]:
    if rows:
        names = ["x", "y", "distance"][:len(kinds)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def by_unit(rows: DataFrame) -> DataFrame:
    return rows.repartition("unit", "part").sortWithinPartitions("unit", "part")


def links_within(rows: DataFrame, percent: int) -> DataFrame:
    """(x, y): a spanning forest of the links among the sets of each (unit, part) of `rows`."""
    def run(batches):
        for held in units_of(batches, ("node", "shingles")):
            edges = block_forest([s for _, s in held], percent)
            yield from link_batch([(held[i][0], held[j][0]) for i, j in edges], pa.int64(), pa.int64())

    return by_unit(rows.select("unit", "part", "node", "shingles")).mapInArrow(run, "x bigint, y bigint")


def _links_to_center(rows: DataFrame, percent: int) -> DataFrame:
    """(x, y, distance): the links of each unit's center with its nodes."""
    def run(batches):
        for held in units_of(batches, ("node", "leads", "shingles")):
            name, center = next(((n, s) for n, leads, s in held if leads), (None, None))
            found = []
            for node, leads, one in held:
                if not leads and center is not None:
                    common, union = _shared_and_all(center, one)
                    if 100 * common >= percent * union:
                        found.append((node, 1 - common / union))
            yield from link_batch([(name, n, d) for n, d in found], pa.int64(), pa.int64(), pa.float64())

    return by_unit(rows.select("unit", "part", "node", "leads", "shingles")).mapInArrow(
        run, "x bigint, y bigint, distance double")


def _links_of_centers(rows: DataFrame, percent: int) -> DataFrame:
    """(x, y, null): a spanning forest of the links of each unit's centers. (x, y, distance): centers that are not
    connected by it, whose members may link."""
    reach = 1 - percent / 100 + _SLACK

    def run(batches):
        for held in units_of(batches, ("node", "radius", "shingles")):
            sets = [s for _, _, s in held]
            edges = block_forest(sets, percent)
            root = list(range(len(held)))
            for i, j in edges:  # from the first member on, so i has its root already
                root[j] = root[i]
            out = [(held[i][0], held[j][0], None) for i, j in edges]
            for i, (node, radius, one) in enumerate(held):
                if radius > 0:
                    for j, (other, width, another) in enumerate(held):
                        if root[i] != root[j] and (width == 0 or i < j):
                            far = reach + radius + width
                            # The union holds the larger set and the intersection is in the smaller.
                            if 1 - min(len(one), len(another)) / max(len(one), len(another)) <= far:
                                common, union = _shared_and_all(one, another)
                                if 1 - common / union <= far:
                                    out.append((node, other, 1 - common / union))
            yield from link_batch(out, pa.int64(), pa.int64(), pa.float64())

    return by_unit(rows.select("unit", "part", "node", "radius", "shingles")).mapInArrow(
        run, "x bigint, y bigint, distance double")


def slot(node: str, of: Column) -> Column:
    return F.pmod(F.xxhash64(node), of).cast("long")


def _stars(sets: DataFrame, ties: DataFrame, percent: int, block: int) -> DataFrame:
    """(x, y, distance): the links of nodes with the least node of the most buckets they share one with."""
    spark = sets.sparkSession
    strongest = freeze(spark, ties.join(sets.select("node"), "node", "left_semi").groupBy("node").agg(
        F.max(F.struct("shared", (-F.col("least")).alias("minus"))).alias("top")).select(
        "node", (-F.col("top.minus")).alias("center")), "strongest")
    # Written before it is joined, so that the join can split the nodes of one center.
    parts = freeze(spark, strongest.groupBy("center").agg(
        F.ceil(F.count(F.lit(1)) / block).cast("long").alias("parts")), "parts")
    placed = (strongest.join(parts, "center")
              .select(F.col("center").alias("unit"), slot("node", F.col("parts")).alias("part"), "node",
                      F.lit(False).alias("leads"))
              .unionByName(parts.select(F.col("center").alias("unit"), F.explode(
                  F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                  F.col("center").alias("node"), F.lit(True).alias("leads"))))
    return freeze(spark, _links_to_center(sets.join(placed, "node"), percent), "stars")


def _homes(sets: DataFrame, stars: DataFrame) -> DataFrame:
    """(node, center, distance): the star a node belongs to; a center belongs to its own."""
    leads = stars.select(F.col("x").alias("node")).distinct().withColumn("leads", F.lit(True))
    found = (sets.select("node").join(stars.select("x", F.col("y").alias("node"), "distance"), "node", "left")
             .join(leads, "node", "left"))
    alone = F.coalesce("leads", F.col("x").isNull())
    return freeze(sets.sparkSession, found.select(
        "node", F.when(alone, F.col("node")).otherwise(F.col("x")).alias("center"),
        F.when(alone, 0.0).otherwise(F.col("distance")).alias("distance")), "homes")


def _bucket_units(buckets: DataFrame, homes: DataFrame, block: int) -> DataFrame:
    """(unit, part, node): centers that meet in a bucket, each set of centers once, cut into pairs of blocks."""
    spark = homes.sparkSession
    # A row per node is joined; its buckets are listed after that.
    inside = freeze(spark, buckets.join(homes, "node").select(
        F.explode("keys").alias("key"), F.col("center").alias("node")).distinct(), "inside")
    units = freeze(spark, inside.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("s1"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s2")).filter("size > 1")
        .groupBy("size", "s1", "s2").agg(F.min("key").alias("key"))
        .select("key", F.ceil(F.col("size") / block).cast("long").alias("blocks")), "units")
    return (inside.join(units, "key").withColumn("own", slot("node", F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .filter("own <> other or blocks = 1")
            .select(F.col("key").alias("unit"),
                    (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("part"), "node"))


def _member_units(near: DataFrame, homes: DataFrame, stars: DataFrame, percent: int, block: int) -> DataFrame:
    """(unit, part, node): members of two stars that may link, cut into pairs of blocks."""
    half = max(1, block // 2)
    sizes = {s: stars.select(F.col("center").alias(s), F.col("radius").alias(f"r{s}"),
                             F.ceil(F.col("members") / half).cast("long").alias(f"k{s}")) for s in "xy"}
    pairs = freeze(near.sparkSession, near.join(sizes["x"], "x").join(sizes["y"], "y"), "star-pairs")
    reach = 1 - percent / 100 + _SLACK
    sides = []
    for own, other in ("xy", "yx"):
        members = homes.select(F.col("center").alias(own), "node", F.col("distance").alias("off"))
        place, each = slot("node", F.col(f"k{own}")), F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"k{other}") - 1))
        sides.append(pairs.join(members, own).filter(F.col("distance") <= F.lit(reach) + F.col("off") + F.col(f"r{other}"))
                     .withColumn("own", place).withColumn("other", each)
                     .select(F.xxhash64("x", "y").alias("unit"),
                             (F.col("own" if own == "x" else "other") * F.col("ky")
                              + F.col("other" if own == "x" else "own")).alias("part"), "node"))
    return sides[0].unionByName(sides[1])


def star_links(sets: DataFrame, ties: DataFrame, buckets: DataFrame, percent: int, block: int) -> DataFrame:
    """(x, y): enough of the links between the sets that meet in a bucket. `ties` has (least, node, shared), the least
    node of a node's buckets and in how many; `buckets` has (node, keys), each node once, and may hold other nodes."""
    spark = sets.sparkSession
    stars = _stars(sets, ties, percent, block)
    homes = _homes(sets, stars)
    sizes = freeze(spark, homes.groupBy("center").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("members")),
                   "star-sizes")
    rows = _bucket_units(buckets, homes, block).join(
        sizes.select(F.col("center").alias("node"), "radius"), "node").join(sets, "node")
    compared = freeze(spark, _links_of_centers(rows, percent), "compared")
    links = stars.select("x", "y").unionByName(compared.filter("distance is null").select("x", "y"))
    near = compared.filter("distance is not null").groupBy("x", "y").agg(F.min("distance").alias("distance"))
    if near.isEmpty():
        return links
    of = freeze(spark, connected_components(links, "x", "y"), "connected")
    for s in "xy":
        near = near.join(of.select(F.col("node").alias(s), F.col("component").alias(f"c{s}")), s, "left")
    apart = near.filter(F.coalesce("cx", "x") != F.coalesce("cy", "y")).select("x", "y", "distance")
    units = _member_units(apart, homes, sizes, percent, block)
    return links.unionByName(links_within(units.join(sets, "node"), percent))
