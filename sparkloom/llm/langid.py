"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by stochastic
gradient descent, with calibrated rejection.

A text is the bag of the hashed character n-grams (with word edges) of its words (runs of letters, lower
case). The mean of their embeddings goes through a linear softmax to language probabilities. Null texts and texts
without a letter are `und`, score 0, and so are all texts if there was nothing to learn from (an empty table, or one
without a language or a letter). Texts whose calibrated probability is under the rejection bound keep their likeliest
language and are marked as not accepted. No rows give no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import map_batches, texts_of
from sparkloom.scratch import freeze

NO_LETTERS = re.compile(r"[\W\d_]+")
UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LangParams:
    bits: int = 16
    dim: int = 16
    longest: int = 4
    per_language: int = 1500
    epochs: int = 5
    batch: int = 32
    rate: float = 2.0
    accept: float = 0.9


def subwords(text: str, params: LangParams) -> np.ndarray:
    """Buckets of all character n-grams (2 to `longest`) of the words, a space standing for a word's edge.

    No n-gram spans two words. Empty if the text has no letter.
    """
    words = NO_LETTERS.sub(" ", text.lower()).strip(" ")
    if not any(map(str.isalpha, words)):
        return np.empty(0, np.int64)
    codes = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edge = codes == 32
    hashed, found = codes.copy(), []
    inside = np.ones(len(codes), bool)
    for n in range(2, params.longest + 1):
        if len(codes) < n:
            break
        # The n-gram's last character joins; its former last one is now inside and may not be an edge.
        hashed = hashed[:-1] * np.uint64(1_000_003) + codes[n - 1:]
        inside = inside[:-1] & ~edge[n - 2:-1] if n > 2 else inside[:-1]
        found.append(hashed[inside] + np.uint64(n))
    mixed = np.concatenate(found) * _MIX
    return (mixed >> np.uint64(64 - params.bits)).astype(np.int64)


@dataclass
class LangModel:
    languages: list[str]
    logits: np.ndarray  # bucket x language: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    accept: float
    params: LangParams


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def no_languages(params: LangParams) -> LangModel:
    return LangModel([], np.zeros((1 << params.bits, 0), np.float32), np.zeros(0, np.float32), 1.0, 1.0, params)


@dataclass
class Bag:
    """The n-grams of a whole text: distinct buckets with the share of each, and its first n-grams in order."""

    buckets: np.ndarray
    shares: np.ndarray
    head: np.ndarray


def fit(samples: list[Bag], target: np.ndarray, languages: list[str], params: LangParams) -> LangModel:
    """SGD with a linearly falling rate; every tenth sample only calibrates temperature and rejection."""
    draw = np.random.default_rng(11)
    embedding = draw.normal(0, 1 / params.dim, (1 << params.bits, params.dim)).astype(np.float32)
    soft = np.zeros((params.dim, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    order = draw.permutation(len(samples))
    kept, learn = order[::10], np.delete(order, np.s_[::10])
    if not len(learn):
        learn = order
    counts = np.maximum(np.bincount(target[learn], minlength=len(languages)), 1)
    per_class = len(learn) / (len(languages) * counts)
    total, done = params.epochs * len(learn), 0
    for _ in range(params.epochs):
        draw.shuffle(learn)
        for start in range(0, len(learn), params.batch):
            rows = learn[start:start + params.batch]
            sizes = np.array([len(samples[i].buckets) for i in rows])
            flat, owner = np.concatenate([samples[i].buckets for i in rows]), np.repeat(np.arange(len(rows)), sizes)
            share = np.concatenate([samples[i].shares for i in rows])[:, None]
            mean = np.add.reduceat(embedding[flat] * share, np.cumsum(sizes) - sizes, axis=0)
            error = _softmax(mean @ soft + bias)
            error[np.arange(len(rows)), target[rows]] -= 1
            error *= per_class[target[rows], None]
            rate = params.rate * (1 - done / total)
            back = (error @ soft.T).astype(np.float32)
            soft -= rate * mean.T @ error / len(rows)
            bias -= rate * error.mean(axis=0)
            order = np.argsort(flat, kind="stable")
            touched, first = np.unique(flat[order], return_index=True)
            embedding[touched] -= rate * np.add.reduceat(back[owner[order]] * share[order], first, axis=0)
            done += len(rows)
    logits = (embedding @ soft).astype(np.float32)
    temperature, accept = _calibrate([samples[i] for i in kept], target[kept], logits, bias, params)
    return LangModel(languages, logits, bias, temperature, accept, params)


def _calibrate(samples, target, logits, bias, params) -> tuple[float, float]:
    """Temperature with the least log loss on texts that were not learned from; the probability from
    which at least `accept` of the predictions hold on short and long cuts of them."""
    if not len(samples):
        return 1.0, params.accept
    z, goal = [], []
    for found, y in zip(samples, target):
        z += [logits[found.head[:40]].mean(axis=0) + bias, logits[found.head[:160]].mean(axis=0) + bias,
              found.shares @ logits[found.buckets] + bias]
        goal += [y] * 3
    z, goal = np.array(z), np.array(goal)
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(z / t)[np.arange(len(z)), goal] + 1e-12).mean() for t in grid]
    best = float(grid[int(np.argmin(loss))])
    p = _softmax(z / best)
    right, sure = p.argmax(axis=1) == goal, p.max(axis=1)
    for bound in np.linspace(1 / z.shape[1], 0.99, 40):
        if (sure >= bound).sum() and right[sure >= bound].mean() >= params.accept:
            return best, float(bound)
    return best, 0.99


def train_langid(docs: DataFrame, learn_from: Column | None = None, params: LangParams = LangParams(),
                 id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> LangModel:
    """Fit on at most `per_language` rows of each language, by hash of the id (the documented bound), and their whole
    texts. `docs` is read twice, whatever the number of languages; an id that is repeated counts once for a language,
    with the least of its texts. `learn_from` is a condition on the columns of `docs`.

    Without a row to learn from the model knows no language, and every text is `und` with score 0.
    """
    rows = docs.filter(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    if learn_from is not None:
        rows = rows.filter(learn_from)
    counts = {r[0]: r[1] for r in rows.groupBy(lang_column).count().collect()}  # a row per language
    if not counts:
        return no_languages(params)
    # A hash threshold with room for chance keeps what is ranked small; the rank sets the exact bound.
    lowest = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (
        lang, int(min(1.0, (1.3 * params.per_language + 100) / n) * (1 << 30)))])
    place = F.xxhash64(id_column)
    some = (rows.filter(F.pmod(place, F.lit(1 << 30)) < F.element_at(lowest, F.col(lang_column)))
            .groupBy(F.col(id_column).alias("__id"), F.col(lang_column).alias("__lang"))
            .agg(F.min(text_column).alias("text")))
    ranked = Window.partitionBy("__lang").orderBy(F.xxhash64("__id"), "__id")
    sample = freeze(docs.sparkSession, some.withColumn("__rank", F.row_number().over(ranked))
                    .filter(F.col("__rank") <= params.per_language).drop("__rank"), "language-sample")

    def make():
        def fill(batch):
            found = [subwords(text, params) for text in texts_of(batch)]
            bags = [np.unique(x, return_counts=True) for x in found]
            return (batch.column("__id"), batch.column("__lang"), [b[0].astype(np.int32) for b in bags],
                    [(b[1] / max(1, b[1].sum())).astype(np.float32) for b in bags],
                    [x[:160].astype(np.int32) for x in found])
        return fill

    kind = sample.schema["__id"].dataType.simpleString()
    got = map_batches(sample, f"id {kind}, lang string, buckets array<int>, shares array<float>, head array<int>",
                      make).toArrow()
    bags = [(i, l, Bag(np.asarray(b.values), np.asarray(s.values), np.asarray(h.values))) for i, l, b, s, h in
            zip(got["id"].to_pylist(), got["lang"].to_pylist(), got["buckets"], got["shares"], got["head"])]
    bags = sorted((r for r in bags if len(r[2].buckets)), key=lambda r: (r[0] is None, r[0], r[1]))
    if not bags:
        return no_languages(params)
    languages = sorted({r[1] for r in bags})
    target = np.array([languages.index(r[1]) for r in bags])
    return fit([r[2] for r in bags], target, languages, params)


class Predictor:
    """Language and calibrated probability of a whole text."""

    def __init__(self, model: LangModel):
        self.model = model
        self._columns = [np.ascontiguousarray(c) for c in model.logits.T]

    def __call__(self, text: str) -> tuple[str, float]:
        found = subwords(text, self.model.params)
        if not len(found) or not self.model.languages:
            return UNKNOWN, 0.0
        mean = np.array([c[found].mean(dtype=np.float64) for c in self._columns])
        z = (mean + self.model.bias) / self.model.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.model.languages[best], float(p[best])


def identify(docs: DataFrame, model: LangModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) of every whole text; one pass, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()

    def make():
        predict = Predictor(sent.value)

        def fill(batch):
            found = [predict(t) for t in texts_of(batch)]
            return (batch.column(0), [f[0] for f in found], [f[1] for f in found],
                    [f[0] != UNKNOWN and f[1] >= sent.value.accept for f in found])
        return fill

    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return (map_batches(narrow, f"id {kind}, lang_pred string, score double, accepted boolean", make)
            .withColumnRenamed("id", id_column))
