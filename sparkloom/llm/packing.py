"""Packing of tokenised texts into sequences of bounded length by fitted length patterns.

1. Every text becomes token ids and an end id; longer ones are cut into pieces of the full length, the
   first piece being what is left over. Pieces are written with their place among the pieces of equal
   length of their task, so a lost task cannot change a number that was used.
2. Only the histogram of piece lengths, one count per length, reaches the driver. Patterns of few lengths
   that fill a sequence are enumerated, and non-negative least squares fits how often each is used.
3. The fit is rounded down to what the histogram holds; residual pieces are packed best fit, longest
   first, by runs of equal lengths, so the work depends on the number of lengths and not of texts.
4. Each pattern takes a range of ranks of each of its lengths, so every piece finds its sequence and its
   offset by its length and rank.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import map_batches, texts_of
from sparkloom.scratch import freeze

#: Characters beyond Latin letters and general punctuation, on whose classes the two libraries may differ.
OTHER_SCRIPTS = re.compile("[^\x00-\u024f\u2000-\u206f]")

#: tiktoken's pattern engine panics on about a million white-space characters in a row; this is far below. The
#: look-behind lets a match begin only where a run does, so that the search is linear.
LONG_SPACE = 100_000
LONG_SPACES = re.compile(r"(?<!\s)\s{%d}" % LONG_SPACE)

#: The pre-tokenizer pattern of byte-level BPE files that ask for one.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_of_symbol() -> dict[str, int]:
    """Byte-level files write printable Latin-1 bytes as themselves and all others as the characters from 256 on."""
    printable = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, equal to what the tokenizers library gives.

    Where a byte-level BPE file ranks its merges by id, as its ranks say the same thing, tiktoken encodes
    the texts from the ranks of that very file, about three times as fast. Texts that hold a special
    token's string, characters of other scripts or a very long run of white space, and all texts of other
    kinds of files, go to the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use all cores
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._special = [t["content"] for t in spec.get("added_tokens") or []]
        self._fast = self._ranked(spec)

    def _ranked(self, spec: dict):
        kind, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = (kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space")
                 and not spec.get("normalizer") and model.get("type") == "BPE"
                 and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                                    "ignore_merges")))
        if not plain:
            return None
        vocabulary, symbol = model["vocab"], byte_of_symbol()
        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            return None
        import tiktoken
        ranks = {bytes(symbol[c] for c in token): k for token, k in vocabulary.items() if token not in self._special}
        return tiktoken.Encoding("from-file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        fast = [self._fast is not None and not any(s in t for s in self._special)
                and (t.isascii() or not OTHER_SCRIPTS.search(t))
                and (len(t) < LONG_SPACE or not LONG_SPACES.search(t)) for t in texts]
        slow = iter(self._tokenizer.encode_batch([t for t, f in zip(texts, fast) if not f], add_special_tokens=False))
        return [np.array(self._fast.encode_ordinary(t) if f else next(slow).ids, "<u4").tobytes()
                for t, f in zip(texts, fast)]


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_column: str = "doc_id",
               text_column: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, local_rank): pieces with their place in their task."""
    kind = docs.schema[id_column].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def make():
        encoder, task = Encoder(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)

        def fill(batch):
            ids, texts = batch.column("id").to_pylist(), texts_of(batch)
            rows = []
            for first in range(0, len(texts), 256):
                for doc, found in zip(ids[first:first + 256], encoder.encode(texts[first:first + 256])):
                    data = memoryview(found + end)
                    n = len(data) // 4
                    start, piece, length = 0, 0, n % capacity or capacity
                    while start < n:
                        crc = zlib.crc32(data[4 * start:4 * (start + length)])
                        rows.append((doc, piece, start, length, crc, task, int(seen[length])))
                        seen[length] += 1
                        start, piece, length = start + length, piece + 1, capacity
            return list(zip(*rows)) if rows else [[]] * 7
        return fill

    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_batches(narrow, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                               "part int, local_rank bigint", make)


def enumerate_patterns(classes: int, present: np.ndarray, copies: int = 6) -> np.ndarray:
    """Patterns of few classes that fill a sequence: a row per pattern, its classes, padded with 0.

    All pairs and triples of present classes with sum `classes`, and several copies of one class with
    what completes them.
    """
    found: set[tuple[int, ...]] = set()
    have = np.zeros(classes + 1, bool)
    have[present] = True
    for a in present:
        if a == classes:
            found.add((int(a),))
        rest = classes - a
        second = present[(present <= a) & (present >= (rest + 1) // 2) & (present <= rest)]
        for b in second[have[rest - second] | (second == rest)]:
            found.add(tuple(x for x in (int(a), int(b), int(rest - b)) if x))
        for n in range(2, copies + 1):
            left = classes - n * a
            if left == 0 or left > 0 and have[left]:
                found.add(tuple(sorted([int(a)] * n + ([int(left)] if left else []), reverse=True)))
    width = max(map(len, found), default=1)
    return np.array([p + (0,) * (width - len(p)) for p in sorted(found)], np.int64).reshape(-1, width)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, most_steps: int = 400, most_at_once: int = 32) -> np.ndarray:
    """Non-negative least squares by an active set: how often to use each pattern, few of them non-zero."""
    x = np.zeros(len(patterns))
    if not len(patterns):
        return x
    classes = len(histogram)
    target = histogram.astype(np.float64)
    target[0] = 0
    used: list[int] = []
    columns = np.zeros((classes, 0))
    scale = max(target.max(), 1.0)
    block, last = most_at_once, np.inf
    for _ in range(most_steps):
        left = target - columns @ x[used] if used else target.copy()
        left[0] = 0
        if np.abs(left).sum() <= 1e-3 * target.sum():
            break
        gain = left[patterns].sum(axis=1)
        gain[used] = -np.inf
        # Several patterns without a common class enter at once; one alone after a step without progress.
        entering, taken = [], np.zeros(classes, bool)
        for best in np.argsort(-gain[:len(gain)], kind="stable")[:64 * block] if block > 1 else [gain.argmax()]:
            if gain[best] <= 1e-6 * scale or len(entering) == block:
                break
            own = patterns[best][patterns[best] > 0]
            if not taken[own].any():
                entering.append(int(best))
                taken[own] = True
        error = float((left * left).sum())
        block = 1 if error >= 0.9999 * last and block > 1 else most_at_once
        last = error
        if not entering:
            break
        for best in entering:
            used.append(best)
            column = np.bincount(patterns[best], minlength=classes).astype(np.float64)
            column[0] = 0
            columns = np.column_stack([columns, column])
        while used:
            gram = columns.T @ columns + 1e-9 * np.eye(len(used))
            solved = np.linalg.solve(gram, columns.T @ target)
            if (solved > 0).all():
                x[used] = solved
                break
            now = x[used]
            falling = solved <= 0
            step = np.min(now[falling] / np.maximum(now[falling] - solved[falling], 1e-300))
            x[used] = now + step * (solved - now)
            keep = ~(falling & (x[used] <= 1e-9 * scale))
            if keep.all():
                keep[np.argmin(np.where(falling, x[used], np.inf))] = False
            for k, stays in zip(used, keep):
                if not stays:
                    x[k] = 0.0
            used, columns = [k for k, stays in zip(used, keep) if stays], columns[:, keep]
    return x


def best_fit_runs(histogram: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over runs of equal lengths: (lengths of a sequence, number of such sequences)."""
    open_by_gap: dict[int, list[list]] = {}
    gaps: list[int] = []

    def put(gap: int, lengths: tuple[int, ...], n: int) -> None:
        if gap not in open_by_gap:
            open_by_gap[gap] = []
            insort(gaps, gap)
        open_by_gap[gap].append([lengths, n])

    for length in range(capacity, 0, -1):
        n = int(histogram[length])
        while n:
            k = bisect_left(gaps, length)
            if k == len(gaps):
                per = capacity // length
                if n >= per:
                    put(capacity - per * length, (length,) * per, n // per)
                if n % per:
                    put(capacity - n % per * length, (length,) * (n % per), 1)
                break
            gap = gaps[k]
            run = open_by_gap[gap][-1]
            # As many copies as best fit would give each of these sequences in turn.
            per = min(gap // length, n)
            take = min(run[1], n // per)
            run[1] -= take
            if not run[1]:
                open_by_gap[gap].pop()
                if not open_by_gap[gap]:
                    del open_by_gap[gap]
                    gaps.pop(k)
            put(gap - per * length, run[0] + (length,) * per, take)
            n -= take * per
    return [(lengths, n) for runs in open_by_gap.values() for lengths, n in runs]


def plan(histogram: np.ndarray, capacity: int, width: int = 1, share: float = 0.9) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, offset) for each length of each pattern.

    `histogram[l]` pieces of length l. Every rank of every length is in exactly one row. Patterns are used
    `share` of the fitted times, which leaves the residual pieces of all lengths, short ones too, that best
    fit needs to fill its sequences.
    """
    total = np.array(histogram, np.int64)
    left = total.copy()
    groups: list[tuple[tuple[int, ...], int]] = []
    # Classes of `width` lengths, named by the longest, so what fits by class fits by length.
    classes = capacity // width
    of_class = -(-np.arange(capacity + 1) // width)
    binned = np.bincount(of_class, weights=left, minlength=classes + 1).astype(np.int64) if classes else left
    if capacity % width == 0 and classes:
        present = np.flatnonzero(binned[1:]) + 1
        patterns = enumerate_patterns(classes, present)
        x = fit_counts(patterns, binned)
        for k in np.argsort(-x, kind="stable"):
            if x[k] < 1:
                break
            names, need = np.unique(patterns[k][patterns[k] > 0], return_counts=True)
            n = int(min(int(x[k] * share), (binned[names] // need).min()))
            binned[names] -= n * need
            slots = [int(c) for c, m in zip(names, need) for _ in range(m)]
            while n:
                # Longest of each class first; a run ends where a class's length does.
                lengths, wanted = [], {}
                for c in slots:
                    length = next(l for l in range(c * width, (c - 1) * width, -1)
                                  if left[l] - wanted.get(l, 0) > 0)
                    wanted[length] = wanted.get(length, 0) + 1
                    lengths.append(length)
                run = int(min(n, *(left[l] // m for l, m in wanted.items())))
                for length, m in wanted.items():
                    left[length] -= run * m
                groups.append((tuple(lengths), run))
                n -= run
    groups += best_fit_runs(left, capacity)
    rows, ranks, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for lengths, n in groups:
        offset = 0
        for length in lengths:
            rows.append((length, int(ranks[length]), n, sequence, offset))
            ranks[length] += n
            offset += length
        sequence += n
    assert (ranks[1:] == total[1:]).all(), "a length is not packed as often as it occurs"
    return rows


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every text.

    Null and empty texts are the end id alone. Repeated rows and ids are packed each. An empty table gives
    no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    pieces = freeze(spark, cut_pieces(docs, tokenizer_path, capacity, end_id, id_column, text_column), "pieces")
    sizes = freeze(spark, pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "piece-sizes")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("n")).collect():  # a count per length
        histogram[length] = n
    rows = plan(histogram, capacity)
    ranges = spark.createDataFrame(rows, "length bigint, rank_from bigint, ranks bigint, sequence_from bigint, "
                                         "offset bigint")
    # The plan's size depends on the number of lengths alone, so it can be broadcast.
    ranked = pieces.join(firsts, ["length", "part"]).withColumn("rank", F.col("first") + F.col("local_rank"))
    placed = ranked.join(F.broadcast(ranges), (ranked["length"] == ranges["length"])
                         & (F.col("rank") >= F.col("rank_from"))
                         & (F.col("rank") < F.col("rank_from") + F.col("ranks")))
    return placed.select(F.col("id").alias(id_column), "piece", "start", pieces["length"], "ids_crc32",
                         (F.col("sequence_from") + F.col("rank") - F.col("rank_from")).alias("sequence_id"),
                         "offset")
