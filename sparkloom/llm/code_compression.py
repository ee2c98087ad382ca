"""Vector codes: each part of a vector becomes the number of its nearest codebook entry, by dual-tree Lloyd.

1. Components become integers, so that all sums and comparisons below are exact.
2. A task takes its rows block by block. For every part position a balanced box tree is built over the block's
   parts, with the sum and number of the parts below each node, and another one over the position's entries.
3. Both trees are walked down together, level by level for all positions at once. For a pair of nodes the boxes
   bound the squared distances from below and above; an entry node that is farther from all parts of a part node
   than some other entry node is from any is dropped for it. Where one entry is left, the whole node is assigned
   and its cached sum counts. Where several are left at a leaf, integer distances decide; ties go to the lower
   entry.
4. A round adds up the tasks' sums by entry and component. The driver holds codebooks, never vectors.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped, and so are vectors
of another length than that of the first kept row by id which can be cut into the parts; null ids come last, rows of
one id are rows like all others (the codebooks start with them in the order of their components). With fewer rows
than entries the codebooks are shorter; no rows give no codebooks and no codes. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import in_parts, map_batches
from sparkloom.llm.vectors import all_finite, floored, matrix_of, slot_sums
from sparkloom.scratch import freeze

_NEVER = np.iinfo(np.int64).max


@dataclass(frozen=True)
class CodeParams:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    block: int = 4096  # vectors whose parts make a tree
    leaf: int = 16  # parts of a leaf
    pairs: int = 20_000  # pairs of leaf and entry that are compared at once


class BoxTree:
    """Balanced trees over the points of several positions: [positions, points, width], halved along the widest
    side of each node's box. Level l has 2^l nodes a position; nodes of a level are numbered position by position.

    The points are filled up to a power of two of leaves with copies of the last one, which weigh nothing.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        positions, n, width = points.shape
        self.levels = max(0, (-(-n // leaf) - 1).bit_length())
        size = -(-n // (1 << self.levels)) << self.levels
        points = np.concatenate((points, np.repeat(points[:, -1:], size - n, axis=1)), axis=1)
        # Place of each point among those given; copies keep the place of the last one.
        index = np.tile(np.minimum(np.arange(size), n - 1), (positions, 1))
        weight = np.tile(np.arange(size) < n, (positions, 1))
        for level in range(self.levels):
            nodes, per = positions << level, size >> level
            points, index, weight = points.reshape(nodes, per, width), index.reshape(nodes, per), weight.reshape(nodes, per)
            widest = np.argmax(points.max(axis=1) - points.min(axis=1), axis=1)
            order = np.argpartition(np.take_along_axis(points, widest[:, None, None], 2)[:, :, 0], per // 2, axis=1)
            points = np.take_along_axis(points, order[:, :, None], 1)
            index, weight = np.take_along_axis(index, order, 1), np.take_along_axis(weight, order, 1)
        self.leaf = size >> self.levels
        self.points = points.reshape(positions << self.levels, self.leaf, width)
        self.index = index.reshape(positions << self.levels, self.leaf)
        self.weight = weight.reshape(positions << self.levels, self.leaf)
        low, high = [self.points.min(axis=1)], [self.points.max(axis=1)]
        total, count = [(self.points * self.weight[:, :, None]).sum(axis=1)], [self.weight.sum(axis=1)]
        for _ in range(self.levels):
            low.insert(0, np.minimum(low[0][::2], low[0][1::2]))
            high.insert(0, np.maximum(high[0][::2], high[0][1::2]))
            total.insert(0, total[0][::2] + total[0][1::2])
            count.insert(0, count[0][::2] + count[0][1::2])
        self.low, self.high, self.total, self.count = low, high, total, count


def box_distances(low_a, high_a, low_b, high_b) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance between points of two boxes, row by row, in integers."""
    apart = np.maximum(np.maximum(low_b - high_a, low_a - high_b), 0)
    across = np.maximum(high_a - low_b, high_b - low_a)
    return (apart ** 2).sum(axis=1), (across ** 2).sum(axis=1)


def dual_walk(parts: BoxTree, entries: BoxTree):
    """Yields (level, part nodes, entries): nodes of which every part has that nearest entry; at last
    (-1, leaves, entries): the pairs that only their points can decide, sorted by leaf.

    Both trees have the same positions; the leaves of `entries` hold one entry each.
    """
    positions = len(parts.low[0])
    p = e = np.arange(positions)
    up, down = 0, 0  # levels of the part nodes and of the entry nodes
    while True:
        near, far = box_distances(parts.low[up][p], parts.high[up][p], entries.low[down][e], entries.high[down][e])
        first = np.flatnonzero(np.diff(p, prepend=-1))
        size = np.diff(np.append(first, len(p)))
        keep = near <= np.repeat(np.minimum.reduceat(far, first), size)
        p, e = p[keep], e[keep]
        if down == entries.levels:
            first = np.flatnonzero(np.diff(p, prepend=-1))
            size = np.diff(np.append(first, len(p)))
            alone = size == 1
            if alone.any():
                yield up, p[first[alone]], entries.index[e[first[alone]], 0]
                open_ = np.repeat(~alone, size)
                p, e = p[open_], e[open_]
            if not len(p):
                return
            if up == parts.levels:
                yield -1, p, entries.index[e, 0]
                return
        if down < entries.levels:
            p, e, down = np.repeat(p, 2), (2 * e[:, None] + np.arange(2)).ravel(), down + 1
        if up < parts.levels:
            p, e = np.concatenate((2 * p, 2 * p + 1)), np.concatenate((e, e))
            order = np.argsort(p, kind="stable")
            p, e, up = p[order], e[order], up + 1


def settle_leaves(parts: BoxTree, codebooks: np.ndarray, leaves: np.ndarray, entries: np.ndarray, pairs: int):
    """Yields (leaves, nearest entry of each point) by integer distances, some whole leaves at a time."""
    n_entries = codebooks.shape[1]
    first = np.flatnonzero(np.diff(leaves, prepend=-1))
    ends = np.append(first, len(leaves))
    start = 0
    while start < len(first):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + pairs, side="right")) - 1)
        at = slice(ends[start], ends[stop])
        book = codebooks[leaves[at] >> parts.levels, entries[at]]
        distance = ((parts.points[leaves[at]] - book[:, None, :]) ** 2).sum(axis=2)
        if int(distance.max()) >= _NEVER // n_entries:
            raise OverflowError("distances and entry numbers do not fit into 64 bits together")
        best = np.minimum.reduceat(distance * n_entries + entries[at][:, None], first[start:stop] - ends[start], axis=0)
        yield leaves[first[start:stop]], best % n_entries
        start = stop


def _part_tree(rows: np.ndarray, positions: int, leaf: int) -> BoxTree:
    n, length = rows.shape
    return BoxTree(np.ascontiguousarray(rows.reshape(n, positions, length // positions).transpose(1, 0, 2)), leaf)


def nearest_sums(rows: np.ndarray, codebooks: np.ndarray, params: CodeParams) -> np.ndarray:
    """[positions, entries, width + 1]: for each entry the sum of the parts nearest to it, and their number."""
    positions, n_entries, width = codebooks.shape
    parts, entries = _part_tree(rows, positions, params.leaf), BoxTree(codebooks, 1)
    sums = np.zeros((positions, n_entries, width + 1), np.int64)
    for level, nodes, found in dual_walk(parts, entries):
        if level >= 0:  # whole nodes: the cached sums count
            np.add.at(sums, (nodes >> level, found),
                      np.concatenate((parts.total[level][nodes], parts.count[level][nodes][:, None]), axis=1))
            continue
        for leaves, codes in settle_leaves(parts, codebooks, nodes, found, params.pairs):
            weight = parts.weight[leaves][:, :, None]
            np.add.at(sums, ((leaves >> parts.levels)[:, None], codes),
                      np.concatenate((parts.points[leaves] * weight, weight), axis=2))
    return sums


def nearest_codes(rows: np.ndarray, codebooks: np.ndarray, params: CodeParams) -> tuple[np.ndarray, np.ndarray]:
    """(codes [rows, positions], squared distances of the rows to what their codes stand for)."""
    positions, _, width = codebooks.shape
    parts, entries = _part_tree(rows, positions, params.leaf), BoxTree(codebooks, 1)
    of_leaf = np.zeros((positions << parts.levels, parts.leaf), np.int64)
    for level, nodes, found in dual_walk(parts, entries):
        if level >= 0:
            below = 1 << (parts.levels - level)
            of_leaf[(nodes[:, None] * below + np.arange(below)).ravel()] = np.repeat(found, below)[:, None]
            continue
        for leaves, codes in settle_leaves(parts, codebooks, nodes, found, params.pairs):
            of_leaf[leaves] = codes
    out = np.zeros((positions, len(rows)), np.int64)
    real = parts.weight.reshape(positions, -1)
    place, code = parts.index.reshape(positions, -1), of_leaf.reshape(positions, -1)
    for k in range(positions):
        out[k, place[k, real[k]]] = code[k, real[k]]
    decoded = codebooks[np.arange(positions)[:, None], out].transpose(1, 0, 2).reshape(len(rows), positions * width)
    return out.T, ((rows - decoded) ** 2).sum(axis=1)


# --- The operator ----------------------------------------------------------------------------------


def integer_vectors(vectors: DataFrame, params: CodeParams, id_column: str, vector_column: str,
                    label_column: str | None) -> DataFrame:
    """(id, label, v): the rows that can be coded, written; all `v` have one length."""
    label = F.lit(None).cast("string") if label_column is None else F.col(label_column)
    usable = vectors.select(F.col(id_column).alias("id"), label.alias("label"), F.col(vector_column).alias("x")).filter(
        all_finite("x") & (F.size("x") > 0) & (F.size("x") % params.parts == 0))
    first = usable.orderBy(F.col("id").asc_nulls_last(), "x").select(F.size("x").alias("length")).first()
    length = first["length"] if first else 0
    return freeze(vectors.sparkSession, usable.filter(F.size("x") == length)
                  .select("id", "label", floored("x", params.scale).alias("v")), "integer-vectors")


def fit_codebooks(rows: DataFrame, params: CodeParams) -> np.ndarray:
    """[positions, entries, width] from rows (id, v) of `integer_vectors`; an empty array of no rows."""
    # As many rows as the codebooks have entries.
    start = rows.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(params.entries).collect()
    if not start:
        return np.zeros((params.parts, 0, 0), np.int64)
    first = np.array([r["v"] for r in start], np.int64)
    books = np.ascontiguousarray(first.reshape(len(first), params.parts, -1).transpose(1, 0, 2))
    for _ in range(params.rounds):
        now = books

        def add(batch: pa.RecordBatch, total: np.ndarray, now: np.ndarray = now) -> None:
            for part in in_parts(iter([batch]), params.block):
                total += nearest_sums(matrix_of(part), now, params).ravel()

        shape = (*books.shape[:2], books.shape[2] + 1)
        sums = np.array(slot_sums(rows, ["v"], add, int(np.prod(shape))), object).reshape(shape)
        count = sums[:, :, -1:]
        moved = sums[:, :, :-1] // np.maximum(count, 1)
        books = np.where(count > 0, moved, books).astype(np.int64)
    return books


def encode(rows: DataFrame, codebooks: np.ndarray, params: CodeParams) -> DataFrame:
    """(id, label, codes, error) of rows (id, label, v): the entry of each part, and the squared distance."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    if not codebooks.size:
        return rows.select("id", "label", F.array().cast("array<int>").alias("codes"),
                           F.lit(0).cast("bigint").alias("error")).limit(0)

    def make():
        def fill(batch):
            codes, errors = nearest_codes(matrix_of(batch), codebooks, params)
            offsets = np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.astype(np.int32).ravel()))
            return batch.column("id"), batch.column("label"), lists, errors
        return fill

    return map_batches(rows, f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error bigint", make,
                       part_rows=params.block)


def decode(codes: np.ndarray, codebooks: np.ndarray) -> np.ndarray:
    """The integer vectors that rows of codes stand for."""
    positions = len(codebooks)
    return codebooks[np.arange(positions)[:, None], np.asarray(codes).T].transpose(1, 0, 2).reshape(len(codes), -1)


def compress(vectors: DataFrame, params: CodeParams = CodeParams(), id_column: str = "vec_id",
             vector_column: str = "embedding", label_column: str | None = "label") -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes, error) of every usable row, and the codebooks that the codes point into."""
    rows = integer_vectors(vectors, params, id_column, vector_column, label_column)
    books = fit_codebooks(rows, params)
    return freeze(vectors.sparkSession, encode(rows, books, params), "codes"), books
