"""Toxicity by a weighted finite-state grammar over clauses.

Words are turned into classes: insults with learned weights (whole words and word beginnings that labelled
toxic texts hold more often than others), threats, targets, negations and reported speech from short lists.
A transducer for each of them reads a clause word by word; their composition multiplies what each says about
a word, so an insult counts more after a target and less when denied or reported, and a threat counts half
without a target. A clause without insult or threat matches nothing. A text's score is a logistic function of what its
matched clauses add up to, fitted on labelled texts whose words were weighed by the other half of the sample.

Null and empty texts match no clause and get the score of a text without matches. Labels, lang, source and
ids are never inputs. Whole texts are read; copies of a text get equal scores.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections import Counter
from collections.abc import Callable, Hashable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import WordCache, labelled_sample, map_batches, sigmoid, texts_of
from sparkloom.scratch import freeze

TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]")
MARKS = frozenset(".!?;\n")
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = range(4, 9)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

#: Small lists of function words and verbs, in the languages the grammar knows.
THREATS = frozenset("kill hurt destroy burn beat smash shoot töten schlagen tuer frapper matar golpear".split())
TARGETS = frozenset("you your yours youre he she they them dich du dir ihr euch tu te toi vous usted tú ti".split())
NEGATIONS = frozenset("not never nobody isnt arent nicht kein keine nie jamais pas nunca jamás".split())
REPORTS = frozenset("said says wrote quoted called claimed sagte schrieb dit disait écrit dijo escribió".split())


# --- Transducers -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Transducer:
    """Reads word classes; each arc gives the next state and a factor for the word just read."""
    start: Hashable
    arc: Callable[[Hashable, int], tuple[Hashable, float]]


def compose(*machines: Transducer) -> Transducer:
    """All machines read the same words; factors multiply. Arcs of the product are built once, when met."""
    known: dict = {}

    def arc(state, symbol):
        found = known.get((state, symbol))
        if found is None:
            steps = [m.arc(s, symbol) for m, s in zip(machines, state)]
            found = known[state, symbol] = tuple(s for s, _ in steps), math.prod(f for _, f in steps)
        return found

    return Transducer(tuple(m.start for m in machines), arc)


def scope(trigger: int, reach: int, inside: Callable[[int], float], outside: Callable[[int], float]) -> Transducer:
    """After a word of class `trigger` the next `reach` words are inside its scope."""
    def arc(left, symbol):
        factor = inside(symbol) if left else outside(symbol)
        return (reach if symbol == trigger else max(0, left - 1)), factor
    return Transducer(0, arc)


HITS = (INSULT, THREAT)
CLAUSE = compose(
    Transducer(None, lambda s, c: (s, float(c in HITS))),  # insults and threats
    scope(TARGET, 4, lambda c: 1.25 if c in HITS else 1.0, lambda c: 0.5 if c == THREAT else 1.0),
    scope(NEGATION, 2, lambda c: 0.6 if c in HITS else 1.0, lambda c: 1.0),
    scope(REPORT, 10_000, lambda c: 0.7 if c in HITS else 1.0, lambda c: 1.0))

THREAT_WEIGHT = 2.0
FEATURES = 8


@dataclass
class ToxicModel:
    lexicon: dict[str, float]
    weights: np.ndarray  # of the features, the last one the intercept


class Reader:
    """Features of a text from its matched clauses."""

    def __init__(self, lexicon: dict[str, float]):
        self._lexicon = lexicon
        self._describe = WordCache(self._class_of)

    def _class_of(self, word: str) -> tuple[int, float]:
        weight = self._lexicon.get(f"={word}", 0.0)
        for n in PREFIXES:
            if len(word) >= n:
                weight = max(weight, self._lexicon.get(word[:n], 0.0))
        if weight > 0:
            return INSULT, weight
        if word in THREATS:
            return THREAT, THREAT_WEIGHT
        return (TARGET if word in TARGETS else NEGATION if word in NEGATIONS else REPORT if word in REPORTS
                else OTHER), 0.0

    def clauses(self, text: str) -> tuple[list[float], int, int]:
        """(totals of the different clauses that match, number of clauses with a word, number of words)."""
        tokens = TOKEN.findall(text.lower())
        described = list(map(self._describe.__getitem__, tokens))
        hits = [k for k, (_, weight) in enumerate(described) if weight]
        if not hits:
            return [], 0, 0
        edges = [-1, *[k for k, t in enumerate(tokens) if t in MARKS], len(tokens)]
        totals: dict[tuple[str, ...], float] = {}
        for at in sorted({bisect(edges, k) for k in hits}):
            clause = slice(edges[at - 1] + 1, edges[at])
            state, total = CLAUSE.start, 0.0
            for symbol, weight in described[clause]:
                state, factor = CLAUSE.arc(state, symbol)
                total += weight * factor
            totals[tuple(tokens[clause])] = total
        clauses = sum(b - a > 1 for a, b in zip(edges, edges[1:]))
        return list(totals.values()), clauses, len(tokens) - len(edges) + 2

    def __call__(self, text: str) -> np.ndarray:
        """What the matched clauses add up to, their squares, the greatest, their mean, and how much of the text they
        are. A clause that is said again adds nothing."""
        out = np.zeros(FEATURES)
        out[-1] = 1.0
        totals, clauses, words = self.clauses(text)
        if totals:
            total = sum(totals)
            out[:-1] = (math.log1p(total), min(total, 30.0) / 10, math.log1p(sum(t * t for t in totals)),
                        max(totals) / 10, total / len(totals) / 5, len(totals) / clauses, min(10.0, 100 * total / words))
        return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 60) -> np.ndarray:
    """Newton steps on the log loss with a small ridge (not on the intercept). Evidence never counts against
    toxicity: features that get a negative weight are left out, and the others are fitted again."""
    used = np.ones(x.shape[1], bool)
    while True:
        z, weight = x[:, used], np.zeros(used.sum())
        penalty = np.full(len(weight), ridge)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = sigmoid(z @ weight)
            slope = z.T @ (p - y) + penalty * weight
            curve = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curve, slope)
            weight = weight - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        if len(weight) == 1 or weight[:-1].min() >= 0:
            break
        used[np.flatnonzero(used)[:-1][weight[:-1] < 0]] = False
    out = np.zeros(x.shape[1])
    out[used] = weight
    return out


def learn_lexicon(counts: dict[str, tuple[int, int]], toxic: int, clean: int, least_docs: int = 3,
                  least_share: float = 0.01, least_ratio: float = 1.5, keep: int = 20_000) -> dict[str, float]:
    """Weights (from smoothed log ratios of document shares) of units that toxic texts hold more often.

    A unit needs `least_docs` toxic texts and a `least_share` of all of them, so that words of a few related
    texts are not learned.
    """
    found, least_docs = [], max(least_docs, least_share * toxic)
    for unit, (a, b) in counts.items():
        ratio = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        if a >= least_docs and ratio >= least_ratio:
            # Rare units are shrunk: a few texts in common prove little. Squares let one telling word outweigh
            # many faint ones, which long texts gather by chance.
            found.append((a * ratio, unit, min(ratio, 5.0) ** 2 / 5.0 * a / (a + 6)))
    found.sort(key=lambda f: (-f[0], f[1]))
    return {unit: ratio for _, unit, ratio in found[:keep]}


def units_of(text: str) -> set[str]:
    """Words (marked) and beginnings of words of a text."""
    words = set(WORD.findall(text.lower()))
    return {f"={w}" for w in words} | {w[:n] for w in words for n in PREFIXES if len(w) >= n}


def train_toxicity(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, per_class: int = 3000,
                   label: str = "toxic") -> ToxicModel:
    """Fit on at most `per_class` labelled rows of each class (the documented bound of the sample). Of their units, the
    200,000 that most toxic texts hold are weighed, and at most 20,000 of them make the lexicon.

    Without labelled rows of both classes the lexicon is empty and only threats match.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, label, learn_from, per_class, (0, 1))
    # Copies of a text are one example; the half a text is in follows from its words.
    sample = sample.groupBy("text").agg(F.max("label").alias("label")).withColumn(
        "half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))
    sample = freeze(spark, sample, "toxic-sample")

    def count():
        def fill(batch):
            got: dict[str, Counter] = {}
            for text, y, half in zip(texts_of(batch), batch.column("label").to_pylist(),
                                     batch.column("half").to_pylist()):
                got.setdefault(f"{half}{y}", Counter()).update(units_of(text))
            rows = [(unit, group, n) for group, c in got.items() for unit, n in c.items()]
            return list(zip(*rows)) if rows else [[], [], []]
        return fill

    units = map_batches(sample, "unit string, grp string, n bigint", count)
    groups = ("00", "01", "10", "11")
    sums = units.groupBy("unit").agg(*[F.sum(F.when(F.col("grp") == g, F.col("n")).otherwise(0)).alias(f"n{g}")
                                       for g in groups]).filter("n01 + n11 >= 3 and (n01 + n11) * 4 > n00 + n10")
    rows = sums.orderBy(F.desc(F.col("n01") + F.col("n11")), "unit").limit(200_000).collect()
    sizes = {(r["half"], r["label"]): r["count"] for r in sample.groupBy("half", "label").count().collect()}

    def lexicon(*halves):
        counts = {r["unit"]: (sum(r[f"n{h}1"] for h in halves), sum(r[f"n{h}0"] for h in halves)) for r in rows}
        return learn_lexicon(counts, sum(sizes.get((h, 1), 0) for h in halves),
                             sum(sizes.get((h, 0), 0) for h in halves))

    crossed = spark.sparkContext.broadcast((lexicon(1), lexicon(0)))

    def read():
        readers = [Reader(x) for x in crossed.value]

        def fill(batch):
            halves = batch.column("half").to_pylist()
            return batch.column("label"), [readers[h](t) for h, t in zip(halves, texts_of(batch))]
        return fill

    got = map_batches(sample, "label int, x array<double>", read).toArrow()
    if not got.num_rows or len(set(got["label"].to_pylist())) < 2:
        return ToxicModel({}, np.array([0.0] * (FEATURES - 1) + [-4.0]))
    x = np.array(got["x"].to_pylist())
    y = np.array(got["label"].to_pylist(), np.float64)
    order = np.lexsort(np.column_stack([x, y]).T)
    # The sample holds as many rows of each class as the bound allows; weigh them as they are.
    return ToxicModel(lexicon(0, 1), fit_logistic(x[order], y[order]))


def score_toxicity(docs: DataFrame, model: ToxicModel, id_column: str = "doc_id", text_column: str = "text",
                   score: str = "score") -> DataFrame:
    """(id, score) of every whole text, 0 to 1, higher: toxic likelier; one pass, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()

    def make():
        reader, weights = Reader(sent.value.lexicon), sent.value.weights

        def fill(batch):
            x = np.array([reader(t) for t in texts_of(batch)]).reshape(-1, FEATURES)
            return batch.column("id"), sigmoid(x @ weights)
        return fill

    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return (map_batches(narrow, f"id {kind}, {score} double", make).withColumnRenamed("id", id_column))
