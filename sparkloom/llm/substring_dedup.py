"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A byte is removed if a string of `length` bytes over it also starts anywhere else, in the same document or
another one. Sorting the suffixes of a whole corpus would take many times its size, so suffixes are put into
buckets first, and only buckets that can hold a repeat are sorted, one block of them at a time.

1. Buckets. Each string of `length` bytes picks the `probe` bytes inside it with the least hash (the last of
   equals). The pick depends on the string alone, so equal strings pick alike and lie in the same bucket, the
   hash of the picked bytes. Neighbouring strings mostly share a pick: a pick stands for a range of starts.
2. Buckets with one pick hold no repeat and are dropped. Picks of one bucket whose ranges agree in every byte
   (by a 64-bit hash of the whole stretch inside a bucket of a 64-bit hash) repeat in full; one of them stands for
   all of them from here on. Two different stretches pass for one with a chance of 2^-128 for each pair of picks:
   under 10^-14 in a corpus of 10^12 picks. Hot stretches are salted.
3. Blocks. In the buckets that are left, the suffixes at all starts of all distinct stretches are sorted a
   block of buckets at a time. Long ties are resolved by ranks of a cover sample: places whose number modulo 7
   is 0, 1 or 3 (any two places have a common distance under 7 to such places) are ranked by prefix doubling up
   to nearly the whole length; head, rank and tail then order two suffixes. Memory is bounded by the block.
   A bucket with more stretches than a block takes is divided first: its strings are grouped by how far into them the
   picked bytes lie, `widths` places to a group, and all bytes that the strings of a group have in common name a
   finer bucket, which goes through steps 2 and 3 in turn. Equal strings are in one group and agree in all bytes, so
   none are parted. Groups of one place leave only equal strings in a bucket, so the division ends.
4. The starts found meet their text, which gives the covered bytes.

Defined results: null is empty; texts under `length` bytes lose nothing; equal rows lose the same bytes (their
strings start in the other row too). Rows are told apart by id and hash of the text.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import in_parts, map_batches
from sparkloom.operators.joins import with_salt
from sparkloom.scratch import freeze

_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: A difference cover modulo 7: every distance modulo 7 lies between two of its numbers.
MODULUS, COVER = 7, (0, 1, 3)


@dataclass(frozen=True)
class RepeatParams:
    length: int = 400
    probe: int = 128
    block_bytes: int = 3_000_000
    hot_stretches: int = 5_000  # distinct stretches of a bucket that one block takes
    widths: tuple[int, ...] = (16, 1)  # places to a group when such a bucket is divided, and divided again


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Picker:
    """Picks of a text: (place, first start, last start, hash of the picked bytes, hash of the stretch)."""

    def __init__(self, length: int, probe: int):
        self.length, self.probe = length, probe
        self._powers = self._inverse = np.ones(1, np.uint64)

    def sums(self, raw: np.ndarray) -> np.ndarray:
        """Prefix sums of a polynomial of the bytes, from which the hash of any stretch follows."""
        if len(self._powers) <= len(raw):
            size = max(1 << 15, 1 << len(raw).bit_length())
            for name, base in (("_powers", _BASE), ("_inverse", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self._powers[:len(raw)], out=sums[1:])
        return sums

    def hashes(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((sums[end] - sums[start]) * self._inverse[start])

    def __call__(self, raw: np.ndarray):
        n, k = len(raw), self.probe
        if n < self.length:
            empty = np.empty(0, np.int64)
            return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
        sums = self.sums(raw)
        own = _mix((sums[k:] - sums[:-k]) * self._inverse[:n - k + 1])
        # Least hash of every window by doubling its width; the later place wins ties.
        least, place, width, wanted = own, np.arange(len(own), dtype=np.int32), 1, self.length - k + 1
        while width < wanted:
            step = min(width, wanted - width)
            later = least[step:] <= least[:-step]
            place = np.where(later, place[step:], place[:-step])
            least = np.where(later, least[step:], least[:-step])
            width += step
        first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        last = np.concatenate((first[1:] - 1, [len(place) - 1]))
        picked = place[first].astype(np.int64)
        return picked, first, last, own[picked], self.hashes(sums, first, last + self.length)


# --- Sorting a block -------------------------------------------------------------------------------


def words_of(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number, in the order of bytes; zeros past the end."""
    padded = np.concatenate((raw, np.zeros(8, np.uint8))).astype(np.uint64)
    words = np.zeros(len(raw), np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k:k + len(raw)]
    return words


def _rank(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def cover_ranks(words: np.ndarray, units: int) -> np.ndarray:
    """Ranks of the `units` * 7 bytes from each sampled place on (rank -1 elsewhere), by prefix doubling.

    A sampled place plus a multiple of 7 is sampled, so ranks of longer prefixes follow from ranks of shorter
    ones of the sample alone.
    """
    n = len(words)
    places = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
    slot = np.full(n + 1, -1, np.int64)
    slot[places] = np.arange(len(places))

    def ahead(ranks: np.ndarray, by: int) -> np.ndarray:
        far = places + by
        return np.where(far < n, ranks[slot[np.minimum(far, n)]] + 1, 0)

    power, reach = _rank(words[places] >> np.uint64(8)), 1
    whole, covered = None, 0
    while True:
        if units & reach:
            whole = power if whole is None else _rank(whole * (len(places) + 1) + ahead(power, covered * MODULUS))
            covered += reach
        if covered == units:
            break
        power, reach = _rank(power * (len(places) + 1) + ahead(power, reach * MODULUS)), reach * 2
    out = np.full(n, -1, np.int64)
    out[places] = whole
    return out


def repeated_starts(raw: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each start whether another one has the same `length` bytes; all must lie inside `raw`.

    Suffixes are sorted by head word, rank at a sampled place and tail word. Two places have a common distance
    to sampled ones, so each suffix is entered once for every class of the cover, and equal suffixes become
    neighbours at least once.
    """
    if not len(starts):
        return np.empty(0, bool)
    words = words_of(raw)
    units = (length - MODULUS + 1) // MODULUS
    # Ranks reach at least to this byte; the words over the rest may overlap with what they cover.
    reached = units * MODULUS
    tails = [length - 8] if reached >= length - 8 else [length - 16, length - 8]
    assert tails[0] >= 0 and reached >= tails[0], "the length is too short for this cover"
    ranks = cover_ranks(words, units)
    ends = _rank(words[starts])
    for tail in tails:
        ends = _rank(ends * (len(starts) + 1) + _rank(words[starts + tail]))
    found = np.zeros(len(starts), bool)
    shifts = [(d - starts) % MODULUS for d in COVER]
    keys = np.concatenate([(ends * len(raw) + ranks[starts + s]) * MODULUS + s for s in shifts])
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    for side in (order[1:][same], order[:-1][same]):
        found[side % len(starts)] = True
    return found


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of set flags."""
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2] - 1


def _sort_blocks(params: RepeatParams, id_type: pa.DataType):
    """Streams stretches sorted by bucket; whole buckets are gathered up to a block and sorted together."""
    schema = pa.schema([("id", id_type), ("h", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])

    def sort_block(rows):
        raw = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
        sizes = np.array([len(r[6]) for r in rows])
        begins = np.cumsum(sizes) - sizes
        counts = sizes - params.length + 1
        starts = np.repeat(begins, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        found = repeated_starts(raw, starts, params.length)
        out, at = [], 0
        for row, n in zip(rows, counts):
            if row[5]:
                for a, b in zip(*runs_of(found[at:at + n])):
                    out.append((row[1], row[2], row[3] + int(a), row[3] + int(b)))
            at += n
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def run(batches):
        block, size = [], 0
        for batch in in_parts(batches):
            columns = [batch.column(c).to_pylist() for c in ("bucket", "id", "h", "first", "last", "alone", "stretch")]
            for row in zip(*columns):
                if size >= params.block_bytes and row[0] != block[-1][0]:
                    yield from sort_block(block)
                    block, size = [], 0
                block.append(row)
                size += len(row[6])
        if block:
            yield from sort_block(block)
    return run


# --- The operator ----------------------------------------------------------------------------------

_PICKS = "id {kind}, h bigint, first bigint, last bigint, before int, bucket bigint, stretch bigint"


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def picks_of(docs: DataFrame, params: RepeatParams, kind: str) -> DataFrame:
    def make():
        pick = Picker(params.length, params.probe)

        def fill(batch):
            sizes, parts = [], []
            for text in batch.column("text").to_pylist():
                found = pick(np.frombuffer(_raw(text), np.uint8))
                sizes.append(len(found[0]))
                if len(found[0]):
                    parts.append(found)
            own = np.repeat(np.arange(len(sizes)), sizes)
            if not parts:
                return [[]] * 7
            _, first, last, bucket, stretch = (np.concatenate(p) for p in zip(*parts))
            before = np.concatenate([p[0] - p[1] for p in parts])
            return (batch.column("id").take(pa.array(own)), batch.column("h").take(pa.array(own)), first, last,
                    before, bucket.view(np.int64), stretch.view(np.int64))
        return fill

    return map_batches(docs, _PICKS.format(kind=kind), make)


def finer_picks(stretches: DataFrame, params: RepeatParams, width: int, kind: str) -> DataFrame:
    """Picks as `picks_of` gives them, of the strings of the stretches, `width` places of the picked bytes to a group."""
    def number(*parts: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "little", signed=True)

    def make():
        def fill(batch):
            out = []
            names = ("id", "h", "first", "last", "before", "bucket", "stretch")
            for doc, h, first, last, before, bucket, raw in zip(*(batch.column(c).to_pylist() for c in names)):
                for group in range((before - (last - first)) // width, before // width + 1):
                    latest = before - group * width
                    earliest = latest - width + 1
                    low, high = max(0, earliest), min(last - first, latest)
                    out.append((doc, h, first + low, first + high, before - low,
                                number(b"%d %d " % (bucket, group), raw[latest:earliest + params.length]),
                                number(raw[low:high + params.length])))
            return list(zip(*out)) if out else [[]] * 7
        return fill

    return map_batches(stretches, _PICKS.format(kind=kind), make)


def _settled(docs: DataFrame, picks: DataFrame, params: RepeatParams, kind: str) -> tuple[DataFrame, DataFrame]:
    """Runs of the picks that repeat in full, and the stretches that must be sorted, with their bytes.

    A stretch comes with its bucket and the number `m` of different ones there.
    """
    spark = docs.sparkSession
    picks = freeze(spark, picks, "picks")
    # Written before it is joined: then both sides of the join are plain shuffles, whose hot keys Spark splits.
    several = freeze(spark, picks.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                     .select("bucket"), "buckets")
    # All that counts of a stretch: its bytes, and where in it the picked bytes are.
    same = ["bucket", "stretch", "before", "width"]
    kept = freeze(spark, picks.withColumn("width", (F.col("last") - F.col("first")).cast("int"))
                  .join(several, "bucket"), "picks-kept")
    distinct = freeze(spark, kept.groupBy(*same).agg(
        F.count(F.lit(1)).alias("n"), F.first("id").alias("id"), F.first("h").alias("h"),
        F.first("first").alias("first"), F.first("last").alias("last")), "stretches")
    repeated = distinct.filter("n > 1").select(*same)
    # Stretches with more picks than a task's even share: fewer of them than there are tasks.
    share = max(1, -(-kept.count() // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    hot = F.broadcast(freeze(spark, distinct.filter(F.col("n") > share).select(
        *same, F.ceil(F.col("n") / share).cast("int").alias("__salts")), "hot-stretches"))
    copies = repeated.join(hot, same, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts")
    full = (with_salt(kept, hot, same, ["id", "h", "first"]).join(copies, [*same, "__salt"], "left_semi")
            .select("id", "h", "first", "last"))
    # Buckets with different stretches, one of which is not known to repeat in full.
    mixed = (distinct.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least"))
             .filter("m > 1 and least = 1").select("bucket", "m"))
    asked = distinct.join(mixed, "bucket").select(
        "id", "h", F.struct("bucket", "m", "first", "last", "before", (F.col("n") == 1).alias("alone")).alias("ask"))
    asked = asked.groupBy("id", "h").agg(F.collect_list("ask").alias("asks"))  # of one text: bounded by it
    with_text = docs.join(asked.withColumnsRenamed({"id": "__id", "h": "__h"}),
                          F.col("id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h"))).select(
        "id", "h", "text", "asks").dropDuplicates(["id", "h"])

    def cut():
        def fill(batch):
            rows = []
            for doc, h, text, asks in zip(*(batch.column(c).to_pylist() for c in ("id", "h", "text", "asks"))):
                raw = _raw(text)
                for a in asks:
                    rows.append((a["bucket"], a["m"], doc, h, a["first"], a["last"], a["before"], a["alone"],
                                 raw[a["first"]:a["last"] + params.length]))
            return list(zip(*rows)) if rows else [[]] * 9
        return fill

    return full, freeze(spark, map_batches(
        with_text, f"bucket bigint, m bigint, id {kind}, h bigint, first bigint, last bigint, before int, alone boolean, "
                   "stretch binary", cut), "stretch-bytes")


def repeated_runs(docs: DataFrame, params: RepeatParams, kind: str) -> DataFrame:
    """(id, h, first, last): ranges of starts of repeated strings of `docs` (id, h, text)."""
    arrow_kind = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    picks, runs = picks_of(docs, params, kind), None
    for width in (*params.widths, None):
        full, stretches = _settled(docs, picks, params, kind)
        hot = stretches.filter(F.col("m") > params.hot_stretches)
        if width is None or hot.isEmpty():
            hot = None
        else:
            stretches = stretches.filter(F.col("m") <= params.hot_stretches)
        sorted_runs = stretches.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
            _sort_blocks(params, arrow_kind), f"id {kind}, h bigint, first bigint, last bigint")
        found = full.unionByName(sorted_runs)
        runs = found if runs is None else runs.unionByName(found)
        if hot is None:
            break
        picks = finer_picks(hot, params, width, kind)
    return runs


def remove_repeats(docs: DataFrame, params: RepeatParams = RepeatParams(), id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept) of every row: removed byte ranges [start, end) and the bytes left."""
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("h"),
                       F.col(text_column).alias("text"))
    runs = repeated_runs(rows, params, kind)
    of_text = runs.groupBy("id", "h").agg(F.collect_set(F.struct("first", "last")).alias("runs"))  # of one text
    joined = rows.join(of_text.withColumnsRenamed({"id": "__id", "h": "__h"}),
                       F.col("id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")), "left")

    def make():
        def fill(batch):
            out = []
            for doc, text, found in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "runs"))):
                raw = _raw(text)
                spans: list[list[int]] = []
                for first, last in sorted((r["first"], r["last"]) for r in found or []):
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], last + params.length)
                    else:
                        spans.append([first, last + params.length])
                kept, at = [], 0
                for start, end in spans:
                    kept.append(raw[at:start])
                    at = end
                kept.append(raw[at:])
                out.append((doc, len(raw), sum(b - a for a, b in spans), [{"start": a, "end": b} for a, b in spans],
                            b"".join(kept)))
            return list(zip(*out)) if out else [[]] * 5
        return fill

    return map_batches(joined.select("id", "text", "runs"),
                       f"id {kind}, n_bytes bigint, n_removed bigint, "
                       "spans array<struct<start: bigint, end: bigint>>, kept binary", make).withColumnRenamed(
        "id", id_column)
