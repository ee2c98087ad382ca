"""Near-duplicate embeddings by cross-polytope hashing, candidates verified by cosine in double precision.

1. Vectors are turned by three rounds of random signs and fast Hadamard transforms; the largest coordinate and
   its sign name the nearest vertex of the cross-polytope. A table's key joins as many vertices as keep the
   expected number of strangers in a bucket low; the last may use few coordinates only.
2. Rows of equal label and vector form a class, which has a number. A class lies in one bucket of each table and
   probes the next likeliest ones (multiprobe: those whose vertex gives up least). All that meet in a bucket are
   tied to its least resident; the components of the ties are clusters of candidates.
3. Clusters are cut into blocks of bounded size and tasks compare two blocks, with one matrix product for each label
   and length in both. They return each class's number of links and a spanning forest of the links.

Vectors are compared only when labels are equal and not null and lengths agree: keys of different labels may fall
together by chance, so both are looked at again for every pair. Null, empty and zero vectors and vectors with null
or non-finite components link with nothing. Rows without an id are alone. Rows that repeat an id are judged each by
their own label and vector and count each as a vector; a component is named by the least id in it. Other columns are
not read; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import in_parts, map_batches
from sparkloom.llm.components import connected_components
from sparkloom.scratch import freeze

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class PolytopeParams:
    least_cosine: float = 0.98
    tables: int = 6
    probes: int = 8
    room: int = 256  # buckets of a table per vector
    block: int = 1024  # vectors of a block
    seed: int = 31


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two; orthonormal."""
    n, width = x.shape
    h = 1
    while h < width:
        pairs = x.reshape(n, width // (2 * h), 2, h)
        x = np.concatenate((pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]), axis=2)
        x = x.reshape(n, width)
        h *= 2
    return x / math.sqrt(width)


class Hasher:
    """Keys of the resident bucket and of the probed ones, for each table, of unit vectors of one length."""

    def __init__(self, length: int, bits: int, params: PolytopeParams):
        self._length, self._params = length, params
        self._width = 1 << max(1, math.ceil(math.log2(max(2, length))))
        full = int(math.log2(2 * self._width))
        # Coordinates that each part of a key looks at; the last part makes up the missing bits.
        self._parts = [self._width] * (bits // full)
        if bits % full:
            self._parts.append(1 << (bits % full - 1))
        draw = np.random.default_rng((params.seed, length))
        self._signs = draw.integers(0, 2, (params.tables, len(self._parts), 3, self._width)) * 2.0 - 1.0

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        n, p = len(unit), self._params
        padded = np.zeros((n, self._width))
        padded[:, :self._length] = unit
        keys = np.zeros((n, p.tables, 1 + p.probes), np.uint64)
        rows = np.arange(n)
        for t in range(p.tables):
            vertices, seconds, loss = [], [], []
            for k, seen in enumerate(self._parts):
                x = padded
                for signs in self._signs[t, k]:
                    x = hadamard(x * signs)
                x = x[:, :seen]
                both = np.concatenate((x, -x), axis=1)
                # The three nearest vertices; the nearest is where the vector lives.
                order = np.argpartition(-both, min(3, both.shape[1] - 1), axis=1)[:, :4]
                order = np.take_along_axis(order, np.argsort(-np.take_along_axis(both, order, 1), axis=1), 1)
                value = np.take_along_axis(both, order, 1)
                vertices.append(order[:, 0])
                for r in range(1, min(4, order.shape[1])):
                    seconds.append((k, order[:, r]))
                    loss.append(value[:, 0] - value[:, r])
            base = np.stack(vertices, axis=1)
            keys[:, t, 0] = self._key(t, base)
            single = np.stack(loss, axis=1)
            # Probes change one part, or two parts at once, in the order of what is lost.
            choices = [(a,) for a in range(len(loss))]
            choices += [(a, b) for a in range(len(loss)) for b in range(a + 1, len(loss))
                        if seconds[a][0] != seconds[b][0]]
            cost = np.stack([sum(single[:, a] ** 2 for a in c) for c in choices], axis=1)
            ranked = np.argsort(cost, axis=1, kind="stable")[:, :p.probes]
            replaced = np.stack([v for _, v in seconds], axis=1)
            for r in range(p.probes):
                other = base.copy()
                chosen = ranked[:, min(r, ranked.shape[1] - 1)]
                for c in np.unique(chosen):
                    at = rows[chosen == c]
                    for a in choices[c]:
                        other[at, seconds[a][0]] = replaced[at, a]
                keys[:, t, 1 + r] = self._key(t, other)
        return keys.reshape(n, -1)

    def _key(self, table: int, parts: np.ndarray) -> np.ndarray:
        key = np.full(len(parts), table * 1_000_003 + self._length, np.uint64)
        for k in range(parts.shape[1]):
            key = key * _MIX1 + parts[:, k].astype(np.uint64) + np.uint64(1)
            key ^= key >> np.uint64(29)
        return key


def _usable(vector) -> np.ndarray | None:
    """The vector divided by its largest size (so no square overflows), or None if it cannot be compared."""
    if vector is None or len(vector) == 0:
        return None
    x = np.asarray([math.nan if v is None else v for v in vector], np.float64)
    top = np.abs(x).max()
    return x / top if math.isfinite(top) and top > 0 else None


def hashed(vectors: DataFrame, bits: int, params: PolytopeParams, columns: tuple[str, str, str]) -> DataFrame:
    """(id, label, d1, d2, vec, keys): digest of label and vector, scaled vector, table keys; null digests and keys
    where a vector can link with nothing."""
    id_column, vector_column, label_column = columns
    kind = vectors.schema[id_column].dataType.simpleString()

    def make():
        hashers: dict[int, Hasher] = {}

        def fill(batch):
            ids, labels = batch.column("id"), batch.column("label").to_pylist()
            rows = [None if l is None else _usable(v) for l, v in zip(labels, batch.column("vec").to_pylist())]
            keys, digests = [None] * len(rows), [(None, None)] * len(rows)
            by_length: dict[int, list[int]] = {}
            for k, row in enumerate(rows):
                if row is not None:
                    by_length.setdefault(len(row), []).append(k)
            for length, at in by_length.items():
                if length not in hashers:
                    hashers[length] = Hasher(length, bits, params)
                for s in range(0, len(at), 512):
                    part = at[s:s + 512]
                    unit = np.stack([rows[k] for k in part])
                    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                    for k, found in zip(part, hashers[length](unit)):
                        name = labels[k].encode()
                        own = hashlib.blake2b(name, digest_size=8).digest()
                        keys[k] = (found ^ np.frombuffer(own, np.uint64)).view(np.int64)
                        whole = hashlib.blake2b(len(name).to_bytes(8, "little") + name + rows[k].tobytes(),
                                                digest_size=16).digest()
                        digests[k] = np.frombuffer(whole, np.int64).tolist()
            return (ids, batch.column("label"), [d[0] for d in digests], [d[1] for d in digests],
                    [None if r is None else r.tobytes() for r in rows], keys)
        return fill

    narrow = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vec"),
                            F.col(label_column).cast("string").alias("label"))
    return map_batches(narrow, f"id {kind}, label string, d1 bigint, d2 bigint, vec binary, keys array<bigint>", make)


def _compare(least: float):
    """Streams rows sorted by (cluster, pair, side): links of one pair of blocks at a time.

    A row (x, null, n) counts links of class x; a row (x, y, 0) is an edge of the spanning forest.
    """
    def links(left, right, same):
        """Counts and forest edges of two lists of (node, copies, vector), all of one label and length."""
        x, y = (np.stack([r[2] for r in g]) for g in (left, right))
        x, y = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (x, y))
        near = x @ y.T >= least
        if same:
            np.fill_diagonal(near, False)
        copies_left, copies_right = (np.array([r[1] for r in g]) for g in (left, right))
        counts = [(r[0], int(n)) for r, n in zip(left, near @ copies_right)]
        if not same:
            counts += [(r[0], int(n)) for r, n in zip(right, copies_left @ near)]
        edges = _forest(near, same, [r[0] for r in left], [r[0] for r in right])
        return [(c, None, n) for c, n in counts if n] + [(i, j, 0) for i, j in edges]

    def run(batches):
        key, blocks, sides = None, 1, {}

        def close():
            first, second = divmod(key[1], blocks)
            left, right = sides.get(first, {}), sides.get(second, {})  # a block may have no rows
            rows = [row for group in left if group in right
                    for row in links(left[group], right[group], first == second)]
            if rows:
                x, y, n = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (x, y, n)], names=["x", "y", "n"])

        for batch in in_parts(batches):
            columns = [batch.column(c).to_pylist() for c in ("cluster", "pair", "blocks", "own", "node", "copies", "label", "vec")]
            for cluster, pair, n_blocks, own, node, copies, label, vec in zip(*columns):
                if (cluster, pair) != key:
                    if sides:
                        yield from close()
                    key, blocks, sides = (cluster, pair), n_blocks, {}
                sides.setdefault(own, {}).setdefault((label, len(vec)), []).append(
                    (node, copies, np.frombuffer(vec, np.float64)))
        if sides:
            yield from close()
    return run


def _forest(near: np.ndarray, same: bool, left: list, right: list) -> list[tuple]:
    """Edges of a spanning forest of a link matrix, breadth first."""
    edges = []
    if same:
        alive = np.ones(len(left), bool)
        for first in range(len(left)):
            if not alive[first]:
                continue
            alive[first] = False
            queue = [first]
            while queue:
                k = queue.pop()
                for j in np.flatnonzero(near[k] & alive):
                    alive[j] = False
                    queue.append(int(j))
                    edges.append((left[k], left[int(j)]))
        return edges
    rows, columns = np.ones(len(left), bool), np.ones(len(right), bool)
    for first in range(len(left)):
        if not rows[first]:
            continue
        rows[first] = False
        queue = [(0, first)]
        while queue:
            side, k = queue.pop()
            line, alive = (near[k], columns) if side == 0 else (near[:, k], rows)
            for j in np.flatnonzero(line & alive):
                alive[j] = False
                queue.append((1 - side, int(j)))
                edges.append((left[k], right[int(j)]) if side == 0 else (right[k], left[int(j)]))
    return edges


def _compared(ones: DataFrame, members: DataFrame, params: PolytopeParams) -> DataFrame:
    """Links inside the clusters of `members` (node, component), as `_compare` gives them."""
    spark = ones.sparkSession
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    placed = freeze(spark, members.join(sizes, "component").select(
        "node", F.col("component").alias("cluster"), F.ceil(F.col("size") / params.block).cast("int").alias("blocks")),
        "clusters")
    held = (ones.select("node", "copies", "label", "vec").join(placed, "node")
            .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("pair", F.least("own", "other").cast("long") * F.col("blocks") + F.greatest("own", "other"))
            .select("cluster", "pair", "blocks", "own", "node", "copies", "label", "vec"))
    return held.repartition("cluster", "pair").sortWithinPartitions("cluster", "pair").mapInArrow(
        _compare(params.least_cosine), "x bigint, y bigint, n bigint")


def near_vectors(vectors: DataFrame, params: PolytopeParams = PolytopeParams(), id_column: str = "vec_id",
                 vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    bits = max(8, math.ceil(math.log2(params.room * max(2, vectors.count()))))
    marked = freeze(spark, hashed(vectors, bits, params, (id_column, vector_column, label_column)), "hashed")
    usable = marked.filter("d1 is not null and id is not null")
    # Written with its numbers, which hold from there on.
    classes = freeze(spark, usable.groupBy("d1", "d2").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
                     .withColumn("node", F.monotonically_increasing_id()), "classes")
    # One row per class: a row of its least id.
    ones = usable.join(classes, ["d1", "d2", "id"]).select("node", "copies", "label", "vec", "keys").dropDuplicates(["node"])
    ones = freeze(spark, ones, "class-rows")
    per_table = 1 + params.probes
    rows = ones.select("node", F.posexplode("keys").alias("pos", "key")).select(
        "node", "key", (F.col("pos") % per_table == 0).alias("lives"))
    # Written before it is joined, so that the join can split hot buckets.
    least = freeze(spark, rows.groupBy("key").agg(
        F.min(F.when(F.col("lives"), F.col("node"))).alias("least"), F.min("node").alias("low"), F.max("node").alias("high"))
        .filter("least is not null and low < high").select("key", "least"), "least")
    ties = freeze(spark, rows.join(least, "key").filter("node <> least").select("least", "node").distinct(), "ties")
    compared = freeze(spark, _compared(ones, connected_components(ties, "least", "node"), params), "compared")
    links = compared.filter("y is null").groupBy(F.col("x").alias("node")).agg(F.sum("n").alias("n"))
    linked = freeze(spark, connected_components(compared.filter("y is not null"), "x", "y").join(
        classes.select("node", "id"), "node"), "linked")
    names = freeze(spark, linked.groupBy("component").agg(F.min("id").alias("found")), "names")
    of_class = (classes.join(links, "node", "left").join(linked.join(names, "component").select("node", "found"), "node", "left")
                .select("d1", "d2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
                        F.coalesce("found", "id").alias("found")))
    out = marked.select("id", "d1", "d2").join(of_class, ["d1", "d2"], "left")
    known = F.col("id").isNotNull()
    return (out.select(F.col("id").alias(id_column),
                       F.when(known, F.coalesce("n", F.lit(0))).otherwise(F.lit(0)).alias("n_links"),
                       F.when(known, F.coalesce("found", "id")).alias("component_id"))
            .withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id"))))
