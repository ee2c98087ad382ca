"""Near-duplicate texts by MinHash with tensored banding, candidates verified on whole shingle sets.

1. One pass gives each text its set size, a 128-bit digest of its set of shingles, and two small collections
   of hashes, each hash made of `half` minhashes. Texts with equal digests form a class, which has a number and
   one representative, the text of that digest whose id is least. All further steps know classes by number, so an
   id that is repeated with another text brings nothing of it along.
2. A table's key combines one hash of the first collection with one of the second, so `m` + `m` hashes make
   m * m tables: the minhash work is about the square root of what independent tables need. `m` follows from
   the similarity so that a pair at the threshold is missed with probability under 1 in 10,000.
3. In each bucket all members are tied to the least one; the components of these ties are clusters of
   candidates.
4. A cluster of at most `block` texts is compared whole, so the work is in proportion to the texts. In a larger one,
   near copies of one text or a chain of chance meetings, texts are compared that share a rare difference from a
   reference text, which all pairs do that link and are not linked by the reference (`difference_links`). Both compare
   full sets. The components of the links are the result.

Words are runs of anything but ASCII white space, A-Z lower-cased. Defined results: texts with fewer words
than a shingle have their whole sequence as one shingle; null texts and texts without words have an empty set
and link with nothing; a row without an id is kept and alone; rows that repeat an id each get the component of
their own text, named by its least id. Where the texts of a component share the least id, those of one digest are
kept.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import broadcast_counted, map_batches, texts_of
from sparkloom.llm.components import connected_components
from sparkloom.llm.difference_links import difference_links
from sparkloom.llm.set_links import links_within
from sparkloom.scratch import freeze

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class MinHashParams:
    words: int = 5
    percent: int = 80  # least similarity in percent
    half: int = 2  # minhashes in a hash of a collection
    miss: float = 1e-4
    block: int = 512  # texts that are compared with one another in a task
    broadcast_rows: int = 500_000  # candidates up to this number are broadcast to fetch their texts

    @property
    def collection(self) -> int:
        good = (self.percent / 100) ** self.half
        return max(2, math.ceil(math.log(self.miss / 2) / math.log(max(1e-12, 1 - good)))) if good < 1 else 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, words: int):
        self._words = words
        self._powers = self._inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            size = max(4096, 1 << (n - 1).bit_length())
            for name, base in (("_powers", _BASE), ("_inverse", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def word_hashes(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
        if not len(raw):
            return np.empty(0, np.uint64)
        self._grow(len(raw) + 1)
        letter = ~_SPACE[raw]
        edges = np.flatnonzero(np.diff(letter, prepend=False, append=False))
        start, end = edges[::2], edges[1::2]
        if not len(start):
            return np.empty(0, np.uint64)
        sums = np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self._powers[:len(raw)])
        sums = np.concatenate((np.zeros(1, np.uint64), sums))
        return _mix((sums[end] - sums[start]) * self._inverse[start])

    def __call__(self, text: str) -> np.ndarray:
        words = self.word_hashes(text)
        if not len(words):
            return words
        n = min(self._words, len(words))
        shingles = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            shingles = _mix(shingles * _MIX2 + words[k:len(words) - n + 1 + k])
        return np.unique(shingles)


def _seeds(n: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhashes(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    return np.array([_mix(shingles * s).min() for s in seeds], np.uint64)


def digest(shingles: np.ndarray) -> np.ndarray:
    """Two 64-bit halves of a digest of a set; zeros for the empty set."""
    if not len(shingles):
        return np.zeros(2, np.int64)
    return np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64)


def signatures(docs: DataFrame, params: MinHashParams, id_column: str, text_column: str) -> DataFrame:
    """(id, n, d1, d2, a0.., b0..): set size, digest of the set, and the two collections of hashes."""
    kind, m = docs.schema[id_column].dataType.simpleString(), params.collection
    names = [f"{c}{i}" for c in "ab" for i in range(m)]

    def make():
        shingler, seeds = Shingler(params.words), _seeds(2 * m * params.half)

        def fill(batch):
            texts = texts_of(batch)
            sizes, digests = np.zeros(len(texts), np.int64), np.zeros((len(texts), 2), np.int64)
            hashes = np.zeros((len(texts), 2 * m), np.int64)
            for k, text in enumerate(texts):
                found = shingler(text)
                sizes[k] = len(found)
                digests[k] = digest(found)
                if len(found):
                    parts = minhashes(found, seeds).reshape(2 * m, params.half)
                    joined = parts[:, 0]
                    for h in range(1, params.half):
                        joined = _mix(joined * _MIX1 + parts[:, h])
                    hashes[k] = joined.view(np.int64)
            return [batch.column("id"), sizes, digests[:, 0], digests[:, 1], *hashes.T]
        return fill

    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_batches(narrow, f"id {kind}, n bigint, d1 bigint, d2 bigint, "
                       + ", ".join(f"{n} bigint" for n in names), make)


def bucket_members(classes: DataFrame, m: int) -> DataFrame:
    """(node, keys): the buckets of all m * m tables that a class lies in."""
    keys = F.array(*[F.xxhash64(F.lit(i * m + j), f"a{i}", f"b{j}") for i in range(m) for j in range(m)])
    return classes.select("node", keys.alias("keys"))


def candidate_ties(buckets: DataFrame) -> DataFrame:
    """(least, node, shared): in how many buckets the least member of a node's buckets is which."""
    rows = buckets.select("node", F.explode("keys").alias("key"))
    # Written before it is joined, so that the join can split hot buckets.
    least = freeze(buckets.sparkSession, rows.groupBy("key").agg(
        F.min("node").alias("least"), F.count(F.lit(1)).alias("size")).filter("size > 1").select("key", "least"), "least")
    return rows.join(least, "key").filter("node <> least").groupBy("least", "node").agg(F.count(F.lit(1)).alias("shared"))


def shingle_sets(docs: DataFrame, classes: DataFrame, members: DataFrame, params: MinHashParams, id_column: str,
                 text_column: str) -> DataFrame:
    """(node, cluster, large, shingles) of the classes in `members` (node, component); written."""
    spark = docs.sparkSession
    sizes = freeze(spark, members.groupBy("component").agg((F.count(F.lit(1)) > params.block).alias("large")), "cluster-sizes")
    placed = members.join(sizes, "component").join(classes.select("node", "id", "d1", "d2"), "node").select(
        "id", "node", "d1", "d2", F.col("component").alias("cluster"), "large")
    placed = broadcast_counted(freeze(spark, placed, "clusters"), params.broadcast_rows)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(placed, "id").drop("id")

    def make():
        shingler = Shingler(params.words)

        def fill(batch):
            # Another text under the representative's id is not of its class.
            asked = zip(batch.column("d1").to_pylist(), batch.column("d2").to_pylist())
            found = [f if tuple(digest(f).tolist()) == d else f[:0]
                     for f, d in zip(map(shingler, texts_of(batch)), asked)]
            return batch.column("node"), batch.column("cluster"), batch.column("large"), [f.tobytes() for f in found]
        return fill

    sets = map_batches(rows, "node bigint, cluster bigint, large boolean, shingles binary", make)
    return freeze(spark, sets.filter(F.length("shingles") > 0), "sets")


def verified_links(docs: DataFrame, classes: DataFrame, ties: DataFrame, params: MinHashParams, id_column: str,
                   text_column: str) -> DataFrame:
    """(x, y): links, enough to connect all classes that candidates link."""
    members = freeze(docs.sparkSession, connected_components(ties, "least", "node"), "members")
    sets = shingle_sets(docs, classes, members, params, id_column, text_column)
    small, large = sets.filter(~F.col("large")), sets.filter("large").select("cluster", "node", "shingles")
    links = links_within(small.select(F.col("cluster").alias("unit"), F.lit(0).alias("part"), "node", "shingles"),
                         params.percent)
    if large.isEmpty():
        return links
    return links.unionByName(difference_links(large, params.percent, params.block))


def _judged(docs: DataFrame, params: MinHashParams, id_column: str, text_column: str) -> DataFrame:
    """(id, n, d1, d2, found, kept) of every row: `found` is the least id of its component."""
    spark = docs.sparkSession
    marked = freeze(spark, signatures(docs, params, id_column, text_column), "signatures")
    m = params.collection
    with_set = marked.filter("n > 0 and id is not null")
    # Written with its numbers, which hold from there on.
    classes = freeze(spark, with_set.groupBy("d1", "d2").agg(
        F.min("id").alias("id"), *[F.first(f"{c}{i}").alias(f"{c}{i}") for c in "ab" for i in range(m)])
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    ties = freeze(spark, candidate_ties(bucket_members(classes, m)), "ties")
    links = freeze(spark, verified_links(docs, classes, ties, params, id_column, text_column), "links")
    linked = classes.select("node", "id", "d1", "d2").join(connected_components(links, "x", "y"), "node")
    linked = freeze(spark, linked.select("component", "node", "id", "d1", "d2"), "linked")
    first = freeze(spark, linked.groupBy("component").agg(F.min(F.struct("id", "d1", "d2")).alias("first")), "firsts")
    linked = linked.join(broadcast_counted(first, params.broadcast_rows), "component").select(
        "node", F.col("first.id").alias("found"),
        ((F.col("d1") == F.col("first.d1")) & (F.col("d2") == F.col("first.d2"))).alias("leads"))
    # Joined by number, so the next join's sides are plain shuffles whose hot digests can be split.
    of_class = classes.select("node", "d1", "d2", F.col("id").alias("own")).join(linked, "node", "left").select(
        "d1", "d2", F.coalesce("found", "own").alias("found"), F.coalesce("leads", F.lit(True)).alias("leads"))
    out = marked.join(of_class, ["d1", "d2"], "left")
    has_class = (F.col("n") > 0) & F.col("id").isNotNull()
    return out.select("id", "n", "d1", "d2", F.when(has_class, F.col("found")).otherwise(F.col("id")).alias("found"),
                      F.when(has_class, F.col("leads") & (F.col("id") == F.col("found"))).otherwise(True).alias("kept"))


def near_duplicates(docs: DataFrame, params: MinHashParams = MinHashParams(), id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row. Other columns are not read; no rows give none."""
    return _judged(docs, params, id_column, text_column).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.col("found").alias("component_id"), "kept")


def drop_near_duplicates(docs: DataFrame, params: MinHashParams = MinHashParams(), id_column: str = "doc_id",
                         text_column: str = "text") -> DataFrame:
    """The rows of `docs` that are kept of their group, all columns. Of rows that repeat an id and its set of
    shingles one stays, rows that repeat an id with another set are judged each; rows without an id stay."""
    spark, name = docs.sparkSession, "__gone"
    judged = freeze(spark, _judged(docs, params, id_column, text_column), "judged")
    found = freeze(spark, judged.groupBy(F.col("id").alias(name))
                   .agg(F.bool_and("kept").alias("__all"), F.bool_or("kept").alias("__kept"),
                        F.count(F.lit(1)).alias("__rows"))
                   .filter(F.col(name).isNotNull() & (~F.col("__all") | (F.col("__rows") > 1))), "gone")
    several = found.filter("__kept").select(name)
    found = broadcast_counted(found.select(name), params.broadcast_rows)
    plain = docs.join(found, F.col(id_column) == F.col(name), "left_anti")
    n_several = several.count()
    if not n_several:
        return plain
    # Ids with several rows, some of them kept: their texts are read again, as only the digest tells them apart.
    several = F.broadcast(several) if n_several <= params.broadcast_rows else several
    repeated = docs.join(several, F.col(id_column) == F.col(name), "left_semi")
    kind = docs.schema[id_column].dataType.simpleString()

    def make():
        shingler = Shingler(params.words)

        def fill(batch):
            digests = np.array([digest(shingler(t)) for t in texts_of(batch)], np.int64).reshape(-1, 2)
            return batch.column("id"), batch.column("text"), digests[:, 0], digests[:, 1]
        return fill

    texts = map_batches(repeated.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).distinct(),
                        f"id {kind}, text string, d1 bigint, d2 bigint", make)
    stay = (texts.join(judged.filter("kept").select("id", "d1", "d2").distinct(), ["id", "d1", "d2"])
            .groupBy("id", "d1", "d2").agg(F.min("text").alias("__text")).select(F.col("id").alias(name), "__text"))
    stay = freeze(spark, stay, "stay")
    once = repeated.join(stay, (F.col(id_column) == F.col(name)) & F.col(text_column).eqNullSafe(F.col("__text")),
                         "left_semi").dropDuplicates([id_column, text_column])
    return plain.unionByName(once)
