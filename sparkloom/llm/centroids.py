"""Centroid clustering: exact integer k-means that skips distances by geometrically tightened bounds.

Each vector carries its cluster, an upper bound of the distance to that cluster's centroid and a lower bound of the
distance to all others. When centroids move, the upper bound grows by the way of its own centroid. The lower bound
shrinks by less than the way of the farthest moved one: a cluster's vectors lie in a sphere around its old centroid,
and how much nearer a moved centroid can have come to any point of that sphere follows from plane geometry
(`most_approach`). A vector whose upper bound is below its lower bound keeps its cluster and no distance is
computed; otherwise its upper bound is made exact, and if that does not settle it, all centroids are scanned in
integers, ties going to the smaller number. So the bounds, in floating point and with a margin, decide only what is
not scanned.

A round is one pass that writes the vectors with their clusters and bounds to the shared folder; only vectors that
changed their cluster are read again, to move the sums of both clusters. Tables of earlier rounds are deleted. The
driver holds centroids and sums by cluster, never vectors.

Defined results: vectors of another length, null ones and those with null or non-finite components are left out;
null and repeated ids are rows like all others (the first centroids come in the order of hash and components, null
ids hash as an empty text). With fewer rows than clusters there are as many clusters as rows; no rows give none.
Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import map_batches
from sparkloom.llm.vectors import all_finite, floored, matrix_of, slot_sums
from sparkloom.scratch import delete_path, new_dir


@dataclass(frozen=True)
class ClusterParams:
    clusters: int = 8
    rounds: int = 10
    scale: int = 1024
    length: int = 64
    seed: int = 3
    part_rows: int = 4096  # vectors worked on at once


@dataclass(frozen=True)
class Clustering:
    """`rows` (id, v, a, u, l, was, scanned, distance) of the last assignment, `a` being the cluster, and its
    centroids."""

    rows: DataFrame
    centroids: np.ndarray


def most_approach(center: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """An upper bound of |x - old| - |x - new| over all x in the sphere: how much nearer a centroid that moves
    from `old` to `new` can have come. It is never above the way moved and below zero for one that moved away.

    All that counts lies in the half plane of the line old-new and the sphere's center, where the sphere is a disk.
    Points for which the difference is 2a > 0 lie inside a branch of a hyperbola around `new`, hence inside its
    asymptotes, which meet in the middle of the way at an angle whose cosine is 2a / way: the tangent from there to
    the disk bounds the difference. If the whole disk lies behind the middle, no point comes nearer, and the angle
    from `old`, which only grows along the way, bounds how much farther it is.
    """
    step = (new - old).astype(float)
    way = float(np.linalg.norm(step))
    if way == 0.0:
        return 0.0

    def steepest(vertex: np.ndarray) -> float:
        """Cosine of the least angle between the way and the view from the vertex to a point of the disk."""
        to = center - vertex
        far = float(np.linalg.norm(to))
        if far <= radius:
            return 1.0
        angle = math.acos(min(1.0, max(-1.0, float(to @ step) / (far * way))))
        return math.cos(max(0.0, angle - math.asin(radius / far)))

    ahead = steepest((old + new) / 2.0)
    return way * ahead if ahead >= 0 else way * min(0.0, steepest(np.asarray(old, float)))


@dataclass(frozen=True)
class Drift:
    """What a round's move does to the bounds, by cluster: growth of upper and loss of lower bounds."""

    grow: np.ndarray
    lose: np.ndarray


def drift_of(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Drift:
    k = len(old)
    grow = np.array([float(np.linalg.norm((new[j] - old[j]).astype(float))) for j in range(k)])
    lose = np.array([max((most_approach(old[i].astype(float), radius[i], old[j], new[j]) for j in range(k) if j != i),
                         default=0.0) for i in range(k)])
    return Drift(grow, lose)


def _squared(v: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    gap = v - centroid
    return np.einsum("ij,ij->i", gap, gap)


def scan(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest centroid, distance to it, distance to the next other one); the smaller number wins ties."""
    best = np.full(len(v), np.iinfo(np.int64).max)
    other, cluster = best.copy(), np.zeros(len(v), np.int64)
    for j, centroid in enumerate(centroids):
        d = _squared(v, centroid)
        nearer = d < best
        other = np.where(nearer, best, np.minimum(other, d))
        best, cluster = np.where(nearer, d, best), np.where(nearer, j, cluster)
    far = np.sqrt(other.astype(float)) if len(centroids) > 1 else np.full(len(v), np.inf)
    return cluster, np.sqrt(best.astype(float)), far


def _clear(u: np.ndarray, l: np.ndarray) -> np.ndarray:
    """Whether the bounds leave no doubt, rounding errors included."""
    finite = np.where(np.isfinite(l), l, 0.0)
    return u + 1e-6 + 1e-9 * (u + np.abs(finite)) < l


def assign(v: np.ndarray, a: np.ndarray, u: np.ndarray, l: np.ndarray, centroids: np.ndarray, drift: Drift):
    """(cluster, upper bound, lower bound, scanned) after the centroids moved."""
    u, l = u + drift.grow[a], l - drift.lose[a]
    open_ = np.flatnonzero(~_clear(u, l))
    exact = np.sqrt(np.array([g @ g for g in v[open_] - centroids[a[open_]]], np.int64).astype(float))
    u[open_] = exact
    open_ = open_[~_clear(exact, l[open_])]
    a, scanned = a.copy(), np.zeros(len(v), bool)
    scanned[open_] = True
    if len(open_):
        a[open_], u[open_], l[open_] = scan(v[open_], centroids)
    return a, u, l, scanned


def integer_rows(vectors: DataFrame, params: ClusterParams, id_column: str, vector_column: str) -> DataFrame:
    usable = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("x")).filter(
        all_finite("x") & (F.size("x") == params.length))
    return usable.select("id", floored("x", params.scale).alias("v"))


def first_centroids(rows: DataFrame, params: ClusterParams) -> np.ndarray:
    """The vectors whose ids, with the seed, have the least hashes: as many as there are clusters."""
    key = F.sha2(F.concat(F.lit(f"{params.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    found = rows.select(key.alias("key"), "v").orderBy("key", "v").limit(params.clusters).collect()
    return np.array([r["v"] for r in found], np.int64).reshape(len(found), params.length)


def _pass(rows: DataFrame, centroids: np.ndarray, drift: Drift | None, params: ClusterParams) -> DataFrame:
    """One assignment of all rows; the first has no bounds to go by and scans."""
    kind = rows.schema["id"].dataType.simpleString()

    def make():
        def fill(batch):
            v = matrix_of(batch)
            if drift is None:
                a, u, l = scan(v, centroids)
                was, scanned = np.full(len(v), -1), np.ones(len(v), bool)
            else:
                was, *bounds = (batch.column(c).to_numpy() for c in ("a", "u", "l"))
                was = was.astype(np.int64)
                a, u, l, scanned = assign(v, was, *bounds, centroids, drift)
            gap = v - centroids[a]
            return batch.column("id"), batch.column("v"), a, u, l, was, scanned, np.einsum("ij,ij->i", gap, gap)
        return fill

    return map_batches(rows, f"id {kind}, v array<int>, a int, u double, l double, was int, scanned boolean, "
                             "distance bigint", make, part_rows=params.part_rows)


def moved_sums(rows: DataFrame, clusters: int, length: int) -> np.ndarray:
    """[clusters, length + 1]: by how much the sums of the clusters and their sizes change with this assignment."""
    def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
        if not batch.num_rows:
            return
        v = matrix_of(batch)
        ones = np.concatenate((v, np.ones((len(v), 1), np.int64)), axis=1)
        sums = total.reshape(clusters, length + 1)
        a, was = (batch.column(c).to_numpy().astype(np.int64) for c in ("a", "was"))
        np.add.at(sums, a, ones)
        np.subtract.at(sums, was[was >= 0], ones[was >= 0])

    return np.array(slot_sums(rows.filter("a <> was"), ["v", "a", "was"], add, clusters * (length + 1)),
                    object).reshape(clusters, length + 1)


def cluster(vectors: DataFrame, params: ClusterParams = ClusterParams(), id_column: str = "vec_id",
            vector_column: str = "embedding") -> Clustering:
    """The assignment after all rounds."""
    spark = vectors.sparkSession
    rows = integer_rows(vectors, params, id_column, vector_column)
    centroids = first_centroids(rows, params)
    k = len(centroids)
    if not k:
        return Clustering(_pass(rows, centroids, None, params).limit(0), centroids)
    sums, drift, before = np.zeros((k, params.length + 1), object), None, None
    for step in range(params.rounds + 1):
        path = new_dir(spark, "clustered")
        assigned = _pass(rows, centroids, drift, params)
        assigned.write.parquet(path)
        rows = spark.read.schema(assigned.schema).parquet(path)
        if before:
            delete_path(spark, before)
        before = path
        if step == params.rounds:
            break
        sums = sums + moved_sums(rows, k, params.length)
        count = sums[:, -1:]
        moved = np.where(count > 0, sums[:, :-1] // np.maximum(count, 1), centroids).astype(np.int64)
        radius = np.zeros(k)
        for r in rows.groupBy("a").agg(F.max("u").alias("u")).collect():  # a row per cluster
            radius[r["a"]] = r["u"] * (1 + 1e-9) + 1e-6
        drift, centroids = drift_of(centroids, moved, radius), moved
    return Clustering(rows, centroids)


def with_inertia(found: Clustering) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid): each row with its cluster's and the whole sum of
    squared distances, and its centroid."""
    spark = found.rows.sparkSession
    sums = {r["a"]: int(r["s"]) for r in found.rows.groupBy("a").agg(F.sum("distance").alias("s")).collect()}
    whole = sum(sums.values())
    # A row per cluster, bounded by the parameter.
    table = spark.createDataFrame([(j, sums.get(j, 0), whole, c.tolist()) for j, c in enumerate(found.centroids)],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return found.rows.select("id", F.col("a").alias("cluster"), "distance").join(F.broadcast(table), "cluster")
