"""Links inside large clusters of sets by how the sets differ from a reference, exact for every pair of a cluster.

Near copies of one text share nearly all of their shingles, so what they share tells nothing; what sets them apart
does. One set of the cluster is its reference. Let a set with n elements differ from it in d elements (those of
either that the other lacks). Two sets that differ in x common elements differ from one another in d1 + d2 - 2x, and so

    100 * intersection >= percent * union   is   2 * (100 + percent) * x >= w1 + w2
                                  with w = (100 + percent) * d - (100 - percent) * n.

1. A set links with the reference where w <= (100 - percent) * n of the reference. These are the core, one component.
   For all other pairs w1 + w2 > 0: they need `x` common differences, 1 at least.
2. Differences are ordered, rare ones first, and a set that needs at least x common ones of its d is listed by its first
   d - x + 1. Of two sets that link, both list the first difference they have in common (prefix filter).
3. Sets listed under one difference are compared, where their places in the order leave room for as many common ones as
   this pair needs and nothing connects them yet. Full sets decide.

Differences with the same sets are one. If more sets than a block are listed under a difference, and these are at most
half of their cluster, they are a cluster of their own with a nearer reference; else they are cut into pairs of blocks.
The reference and the order of rarity come from about `SAMPLE` sets of a cluster; they change the work and no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.set_links import by_unit, link_batch, slot, units_of
from sparkloom.scratch import freeze

SAMPLE = 256
_MODEL = "unit bigint, node bigint, leads boolean, rarity binary, shingles binary"
_DIFFERENCES = "cluster bigint, node bigint, leader bigint, core boolean, d bigint, weight bigint, tokens array<bigint>"


def _models(sets: DataFrame, sizes: DataFrame) -> DataFrame:
    """(unit, node, leads, rarity, shingles): the reference of each cluster, the set of the sample that is nearest to what
    more than half of them hold, and the elements that several of the sample hold with their numbers."""
    step = F.ceil(F.col("members") / SAMPLE)
    sample = (sets.join(sizes, "cluster").filter(F.pmod(F.xxhash64("node"), step) == 0)
              .select(F.col("cluster").alias("unit"), F.lit(0).alias("part"), "node", "shingles"))

    def run(batches):
        for unit, held in units_of(batches, ("node", "shingles"), keyed=True):
            values, counts = np.unique(np.concatenate([s for _, s in held]), return_counts=True)
            usual = values[2 * counts > len(held)]
            node, reference = min(held, key=lambda x: (
                len(x[1]) + len(usual) - 2 * int(np.isin(x[1], usual, assume_unique=True).sum()), x[0]))
            several = counts > 1
            # An element of the reference is a difference of those that lack it.
            counts = np.where(np.isin(values, reference, assume_unique=True), len(held) - counts, counts)
            rarity = np.stack((values[several], counts[several].astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([unit], pa.int64()), pa.array([node], pa.int64()), pa.array([True]),
                 pa.array([rarity.tobytes()], pa.binary()), pa.array([reference.tobytes()], pa.binary())],
                names=["unit", "node", "leads", "rarity", "shingles"])

    return by_unit(sample).mapInArrow(run, _MODEL)


def least_common(weight: int, size: int, core: bool, reference: int, percent: int) -> int:
    """Least number of differences in common with another set that links; of the core, only with one that is not."""
    whole, rest = 100 + percent, 100 - percent
    # No weight is below the reference's, -rest * reference; outside the core they are above rest * reference.
    bound = -((weight + rest * reference + 1) // -(2 * whole)) if core else -((weight - rest * reference) // -(2 * whole))
    # The other has at most 100 / percent times the size and at least as many differences as are common.
    return max(1, bound, -((weight - rest * (100 * size // percent)) // -whole))


def differences(sets: DataFrame, models: DataFrame, sizes: DataFrame, percent: int, block: int) -> DataFrame:
    """(cluster, node, leader, core, d, weight, tokens) of every set; `tokens` are the differences it is listed by."""
    parts = sizes.select("cluster", F.ceil(F.col("members") / block).cast("long").alias("parts"))
    rows = sets.join(parts, "cluster").select(
        F.col("cluster").alias("unit"), slot("node", F.col("parts")).alias("part"), "node", F.lit(False).alias("leads"),
        F.lit(None).cast("binary").alias("rarity"), "shingles")
    models = models.join(parts.withColumnRenamed("cluster", "unit"), "unit").select(
        "unit", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "node", "leads", "rarity",
        "shingles")

    def run(batches):
        none = np.empty(0, np.uint64)
        for unit, held in units_of(batches, ("node", "leads", "rarity", "shingles"), keyed=True):
            leader, rarity, reference = next(((n, r, s) for n, leads, r, s in held if leads), (None, b"", none))
            values, counts = np.frombuffer(rarity, np.uint64).reshape(2, -1)
            out = []
            for node, leads, _, one in held:
                if leads:
                    continue
                other = np.setxor1d(one, reference, assume_unique=True)
                d, n = len(other), len(one)
                weight = (100 + percent) * d - (100 - percent) * n
                core = weight <= (100 - percent) * len(reference)
                listed = max(0, d - least_common(weight, n, core, len(reference), percent) + 1)
                seen = np.zeros(d, np.int64)
                if len(values):
                    at = np.minimum(np.searchsorted(values, other), len(values) - 1)
                    seen = np.where(values[at] == other, counts[at], 0).astype(np.int64)
                first = other[np.lexsort((other, seen))[:listed]]
                out.append((unit, node, leader, core, d, weight, first.view(np.int64)))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(map(list, zip(*out)), kinds)], names=[
                    "cluster", "node", "leader", "core", "d", "weight", "tokens"])

    return by_unit(rows.unionByName(models)).mapInArrow(run, _DIFFERENCES)


def _listed(found: DataFrame) -> DataFrame:
    return found.select("cluster", "node", "core", "d", "weight", F.posexplode("tokens").alias("pos", "token"))


def listings(found: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """(cluster, token, blocks, again): the differences under which sets are to be compared, each set of sets once, and
    whether these are a cluster of their own."""
    groups = _listed(found).groupBy("cluster", "token").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("s1"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s2"), F.min("pos").alias("first"), F.bool_and("core").alias("core"))
    # Of differences with the same sets the first is kept: two sets' first common one is never among the others.
    once = groups.filter("size > 1 and not core").groupBy("cluster", "size", "s1", "s2").agg(
        F.min_by("token", F.struct("first", "token")).alias("token"))
    return once.join(sizes, "cluster").select(
        "cluster", "token", F.ceil(F.col("size") / block).cast("long").alias("blocks"),
        ((F.col("size") > block) & (2 * F.col("size") <= F.col("members"))).alias("again"))


def _compared(rows: DataFrame, percent: int) -> DataFrame:
    """(x, y): links of the sets of each (unit, part), enough to connect all that may link by their places."""
    whole = 2 * (100 + percent)

    def run(batches):
        for held in units_of(batches, ("node", "pos", "d", "weight", "core", "shingles")):
            nodes, pos, d, weight, core, sets = zip(*held)
            left, weight, core = np.array(d) - np.array(pos), np.array(weight), np.array(core)
            sizes = np.array([len(s) for s in sets])
            root, out = np.arange(len(held)), []
            for i in range(len(held) - 1):
                need = -((weight[i] + weight[i + 1:]) // -whole)
                may = (need <= left[i]) & (need <= left[i + 1:]) & ~(core[i] & core[i + 1:]) & (root[i + 1:] != root[i])
                others = np.flatnonzero(may) + i + 1
                if not len(others) or not len(sets[i]):
                    continue
                flat = np.concatenate([sets[j] for j in others])
                at = np.minimum(np.searchsorted(sets[i], flat), sizes[i] - 1)
                common = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.cumsum(sizes[others]) - sizes[others])
                for j in others[100 * common >= percent * (sizes[i] + sizes[others] - common)]:
                    if root[j] != root[i]:
                        root[root == root[j]] = root[i]
                        out.append((nodes[i], nodes[j]))
            yield from link_batch(out, pa.int64(), pa.int64())

    return by_unit(rows).mapInArrow(run, "x bigint, y bigint")


def difference_links(sets: DataFrame, percent: int, block: int) -> DataFrame:
    """(x, y): enough links to connect all sets of a cluster that are connected by links. `sets` has (cluster, node,
    shingles): sorted distinct hashes as bytes, none empty; written. No rows give no links."""
    spark, full = sets.sparkSession, sets.select("node", "shingles")
    links = None
    while True:
        sizes = freeze(spark, sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("members")), "members")
        models = freeze(spark, _models(sets, sizes), "references")
        found = freeze(spark, differences(sets, models, sizes, percent, block), "differences")
        groups = freeze(spark, listings(found, sizes, block), "listings")
        rows = _listed(found).join(groups, ["cluster", "token"]).withColumn("unit", F.xxhash64("cluster", "token"))
        placed = (rows.filter("not again").withColumn("own", slot("node", F.col("blocks")))
                  .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
                  .filter("own <> other or blocks = 1")
                  .withColumn("part", F.least("own", "other") * F.col("blocks") + F.greatest("own", "other"))
                  .select("unit", "part", "node", "pos", "d", "weight", "core"))
        compared = freeze(spark, _compared(placed.join(full, "node"), percent), "compared")
        new = found.filter("core and node <> leader").select(F.col("leader").alias("x"), F.col("node").alias("y"))
        new = new.unionByName(compared)
        links = new if links is None else links.unionByName(new)
        if groups.filter("again").isEmpty():
            return links
        sets = freeze(spark, rows.filter("again").select(F.col("unit").alias("cluster"), "node").join(full, "node"), "again")
