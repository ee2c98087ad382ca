"""Personal data: fixed base patterns, and a semi-Markov conditional random field that adds spans to them.

Base spans (email, ip, card, phone) are the leftmost non-overlapping matches of each kind's pattern; a match
that fails its check is dropped without a retry. They always stay. Between them the random field looks at
regions of digits and separators and at words around an `@`. A candidate segment is a run of at most
`MOST_ATOMS` atoms (digit groups, letters, marks); features of the whole span (digits, groups, separators,
checksum, number ranges, neighbours) score it for each kind, and dynamic programming over segments chooses
boundaries and kinds jointly. So two cards or a phone and a card that a base pattern runs together, and
addresses with letters beyond ASCII, are found.

The field is trained on spans and other numbers of a bounded sample of texts, the base patterns giving the
labels, with neighbours put side by side as the base patterns cannot split them.

Defined results: null and empty texts have no spans; offsets are code points, end exclusive; equal rows
give equal spans. Time is linear in the length of a text.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import in_parts, map_batches, texts_of
from sparkloom.scratch import freeze

KINDS = ("email", "ip", "card", "phone")
MOST_ATOMS = 12

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """The card checksum."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[Span]:
    """By kind as in KINDS, then by start."""
    if not _TRIGGER.search(text):
        return []
    found: list[Span] = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return found


# --- Regions, atoms and whole-span features --------------------------------------------------------

_NUMERIC = re.compile(r"[0-9][ ().+0-9-]*")
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|\s|.", re.S)


def regions(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Stretches worth decoding: digits with their separators and words with an `@`, without `taken` spans."""
    found = []
    for m in _NUMERIC.finditer(text):
        start, end = m.span()
        while start > 0 and text[start - 1] in "+(" and m.start() - start < 2:
            start -= 1
        found.append((start, start + len(text[start:end].rstrip(" (.+-"))))
    at = text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        found.append((start, end))
        at = text.find("@", end)
    merged: list[list[int]] = []
    for start, end in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    busy = sorted((a, b) for _, a, b in taken)
    out, k = [], 0
    for start, end in merged:
        while k < len(busy) and busy[k][1] <= start:
            k += 1
        j, at = k, start
        while j < len(busy) and busy[j][0] < end:
            if at < busy[j][0]:
                out.append((at, busy[j][0]))
            at = max(at, busy[j][1])
            j += 1
        if at < end:
            out.append((at, end))
    return out


def span_features(text: str, start: int, end: int) -> list[str]:
    """Features of a whole span, shared by all kinds (a weight belongs to a kind and a feature)."""
    span = text[start:end]
    groups = re.findall(r"[0-9]+", span)
    n = sum(map(len, groups))
    marks = "".join(sorted({c for c in span if not c.isalnum()}))
    out = ["bias", f"marks={marks[:6]}", f"digits={n if 8 <= n <= 19 else 'few' if n < 8 else 'many'}",
           f"groups={min(len(groups), 5)}"]
    if "@" in span:
        local, _, domain = span.partition("@")
        parts = domain.split(".")
        whole = (span.count("@") == 1 and local and len(parts) > 1
                 and all(p.replace("-", "").isalnum() for p in parts)
                 and all(c.isalnum() or c in "._%+-" for c in local))
        out.append(f"address={bool(whole)}")
        if whole:
            more = (start > 0 and (text[start - 1].isalnum() or text[start - 1] in "._%+-")
                    or re.match(r"[.-]?[^\W_]", text[end:end + 2]))
            out.append(f"address_open={bool(more)}")
    elif any(c.isalpha() for c in span):
        out.append("letters")
    elif not span[0].isdigit() and span[0] not in "+(" or not span[-1].isdigit():
        out.append("ragged")
    else:
        plain = all(a.isdigit() or a in " -" for a in span) and not re.search(r"[ -]{2}", span)
        if 13 <= n <= 19 and plain:
            out.append(f"checksum={luhn(''.join(groups))},{len(groups) == 1 or [*map(len, groups)] == [4] * len(groups)}")
        quad = len(groups) == 4 and set(span) <= set("0123456789.") and span.count(".") == 3
        if quad:
            out.append(f"quad={all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
        if span[0] == "+":
            shape = "-".join(str(len(g)) for g in groups[1:])
            out += [f"plus,{9 <= n <= 15}", f"shape={shape}"]
            if re.search(r"\([0-9]+\)", span):
                out.append("plus,brackets")
        near = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
        if near:
            out.append("joined")
    return out


@dataclass
class Lattice:
    """Candidate segments of a region: `ends[j]` holds (first atom, features) of segments before atom j."""
    offsets: list[int]
    ends: list[list[tuple[int, list[str]]]] = field(default_factory=list)


def lattice(text: str, start: int, end: int) -> Lattice:
    atoms = [m.span() for m in _ATOM.finditer(text, start, end)]
    offsets = [a for a, _ in atoms] + [end]
    out = Lattice(offsets, [[] for _ in offsets])
    digits, ats = [0], [0]
    for a, b in atoms:
        digits.append(digits[-1] + (b - a if "0" <= text[a] <= "9" else 0))
        ats.append(ats[-1] + (text[a] == "@"))
    for j in range(1, len(offsets)):
        last = text[offsets[j] - 1]
        if not (last.isalnum() or last == ")"):
            continue
        for i in range(max(0, j - MOST_ATOMS), j):
            first = text[offsets[i]]
            # No kind has two @, and without one none has fewer than 4 digits or more than 19.
            n, at = digits[j] - digits[i], ats[j] - ats[i]
            if (first.isalnum() or first in "+(") and (at == 1 or at == 0 and 4 <= n <= 19):
                out.ends[j].append((i, span_features(text, offsets[i], offsets[j])))
    return out


# --- The random field ------------------------------------------------------------------------------

Weights = dict[tuple[str, str], float]
#: An atom outside any span scores 0; a span's features must add up to more than that.


def _score(weights: Weights, kind: str, features: list[str]) -> float:
    return sum(weights.get((kind, f), 0.0) for f in features)


def decode(weights: Weights, lat: Lattice) -> list[Span]:
    """Best segmentation: atoms outside score 0, segments the sum of their weights (semi-Markov Viterbi)."""
    n = len(lat.offsets) - 1
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        best[j], back[j] = best[j - 1], (j - 1, None)
        for i, features in lat.ends[j]:
            for kind in KINDS:
                value = best[i] + _score(weights, kind, features)
                if value > best[j] + 1e-12:
                    best[j], back[j] = value, (i, kind)
    spans, j = [], n
    while j > 0:
        i, kind = back[j]
        if kind:
            spans.append((kind, lat.offsets[i], lat.offsets[j]))
        j = i
    return spans[::-1]


def _log_add(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def gradient(weights: Weights, lat: Lattice, gold: set[Span]) -> tuple[float, dict[tuple[str, str], float]]:
    """Log likelihood of the gold segmentation and its gradient: gold minus expected features."""
    n = len(lat.offsets) - 1
    scored = [[(i, f, [_score(weights, k, f) for k in KINDS]) for i, f in lat.ends[j]] for j in range(n + 1)]
    ahead = [0.0] * (n + 1)
    for j in range(1, n + 1):
        ahead[j] = _log_add([ahead[j - 1]] + [ahead[i] + s for i, _, ss in scored[j] for s in ss])
    behind = [0.0] * (n + 1)
    incoming: list[list[float]] = [[] for _ in range(n + 1)]
    for j in range(n, 0, -1):
        if j < n:
            behind[j] = _log_add(incoming[j])
        incoming[j - 1].append(behind[j])
        for i, _, ss in scored[j]:
            incoming[i] += [behind[j] + s for s in ss]
    slope: dict[tuple[str, str], float] = defaultdict(float)
    likelihood = -ahead[n]
    for j in range(1, n + 1):
        for i, features, ss in scored[j]:
            for kind, s in zip(KINDS, ss):
                is_gold = (kind, lat.offsets[i], lat.offsets[j]) in gold
                change = is_gold - math.exp(ahead[i] + s + behind[j] - ahead[n])
                if is_gold:
                    likelihood += s
                if abs(change) > 1e-6:
                    for f in features:
                        slope[kind, f] += change
    return likelihood, slope


def fit(examples: list[tuple[str, list[Span]]], epochs: int = 6, rate: float = 0.5, decay: float = 1e-3) -> Weights:
    """Maximum likelihood by adaptive stochastic gradient ascent on (text, gold spans) examples."""
    prepared = [(lattice(text, 0, len(text)), set(gold)) for text, gold in examples]
    weights: Weights = defaultdict(float)
    squares: dict[tuple[str, str], float] = defaultdict(float)
    draw = np.random.default_rng(5)
    for kind in KINDS:
        weights[kind, "bias"] = -3.0
    for _ in range(epochs):
        for k in draw.permutation(len(prepared)):
            for key, g in gradient(weights, *prepared[k])[1].items():
                g -= decay * weights[key]
                squares[key] += g * g
                weights[key] += rate * g / math.sqrt(squares[key] + 1e-8)
    return dict(weights)


def made_up_spans(draw: np.random.Generator, n: int) -> list[tuple[str, str]]:
    """(kind, text) of formats the patterns describe, so that every kind is learned on any corpus; kind ""
    marks numbers that are no personal data."""
    def number(k):
        return "".join(map(str, draw.integers(0, 10, k)))

    def card(k):
        head = number(k - 1)
        return next(head + c for c in "0123456789" if luhn(head + c))

    out = []
    for _ in range(n):
        c = card(16)
        out += [("card", c), ("card", f"{c[:4]}-{c[4:8]}-{c[8:12]}-{c[12:]}"), ("card", card(int(draw.integers(13, 20)))),
                ("phone", f"+{draw.integers(1, 99)} ({number(3)}) {number(3)}-{number(4)}"),
                ("phone", f"+{draw.integers(1, 99)} {number(3)} {number(3)} {number(4)}"),
                ("phone", f"+{number(11)}"),
                ("ip", ".".join(map(str, draw.integers(0, 256, 4)))),
                ("email", f"josé.{number(2)}@mail{number(1)}.example.com"),
                ("email", f"ana{number(2)}@bücher.example"), ("email", f"x.{number(2)}@mail{number(1)}.example.com")]
        bad = number(16)
        out += [("", bad if not luhn(bad) else bad[:-1] + str((int(bad[-1]) + 1) % 10)), ("", number(int(draw.integers(1, 9)))),
                ("", f"{draw.integers(0, 20)}.{draw.integers(0, 20)}"), ("", f"{draw.integers(256, 999)}." + ".".join(
                    map(str, draw.integers(0, 256, 3)))), ("", f"{number(4)}-{number(2)}-{number(2)}"), ("", number(30)),
                ("", f"+{number(3)}"), ("", f"a@{number(2)}"), ("", f"{number(3)}-{number(4)}")]
    return out


def training_examples(found: list[tuple[str, str]], seed: int = 17) -> list[tuple[str, list[Span]]]:
    """Spans alone and side by side, as a base pattern would run them together."""
    draw = np.random.default_rng(seed)
    out = []
    order = draw.permutation(len(found))
    for k in order:
        chosen = [found[k]] + [found[int(j)] for j in draw.integers(0, len(found), int(draw.integers(0, 3)))]
        text, gold = "", []
        for kind, piece in chosen:
            if text:
                text += " "
            if kind:
                gold.append((kind, len(text), len(text) + len(piece)))
            text += piece
        out.append((text, gold))
    return out


def train_pii(docs: DataFrame, sample_rows: int = 2000, spans_kept: int = 200, longest: int = 40,
              text_column: str = "text") -> Weights:
    """Fit the field on base spans and other numbers of `sample_rows` different texts, by hash of the text (the
    documented bound), and on a few made-up ones. `docs` is read once beside its count. Of each kind, `spans_kept`
    different strings of up to `longest` characters, by hash, are learned from and reach the driver.

    Texts and strings are picked by what they are, so the files and partitions they lie in make no difference. Without
    rows the made-up strings are learned from alone.
    """
    spark, rows = docs.sparkSession, docs.count()
    place = F.xxhash64(text_column)
    # A hash threshold with room for chance keeps the sort small; copies of a text count once.
    share = min(1.0, (1.3 * sample_rows + 100) / max(1, rows))
    some = (docs.select(F.col(text_column).alias("text"), place.alias("place"))
            .filter(F.col("text").isNotNull() & (F.pmod("place", F.lit(1 << 30)) < int(share * (1 << 30))))
            .groupBy("place").agg(F.min("text").alias("text")).orderBy("place").limit(sample_rows))
    some = freeze(spark, some.select("text"), "pii-sample")

    def make():
        def fill(batch):
            got = set()
            for text in texts_of(batch):
                base = base_spans(text)
                loose = [("", a, b) for a, b in regions(text, base)]
                got |= {(kind, text[a:b]) for kind, a, b in base + loose
                        if b - a <= longest and not (kind == "" and len(_digits(text[a:b])) > 19)}
            return list(zip(*sorted(got))) if got else [[], []]
        return fill

    got = map_batches(some, "kind string, span string", make).distinct()
    ranked = Window.partitionBy("kind").orderBy(F.xxhash64("span"), "span")
    kept = got.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= spans_kept)
    found = sorted((r.kind, r.span) for r in kept.collect())
    return fit(training_examples(found + made_up_spans(np.random.default_rng(23), 20)))


def all_spans(text: str, weights: Weights) -> tuple[list[Span], list[Span]]:
    """(base spans, base and added spans), by kind as in KINDS, then by start."""
    base = base_spans(text)
    added: list[Span] = []
    if _TRIGGER.search(text):
        for start, end in regions(text, base):
            if end - start >= 6:
                added += decode(weights, lattice(text, start, end))
    if not added:
        return base, base
    return base, sorted({*base, *added}, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find_pii(docs: DataFrame, weights: Weights, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, base, spans) of every text: arrays of (kind, start, end). One pass, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.schema[id_column].dataType.simpleString()
    spans = "array<struct<kind: string, start: bigint, end: bigint>>"

    def make():
        def fill(batch):
            both = [all_spans(t, sent.value) for t in texts_of(batch)]
            shown = [[[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in pair] for pair in both]
            return batch.column("id"), [p[0] for p in shown], [p[1] for p in shown]
        return fill

    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_batches(narrow, f"id {kind}, base {spans}, spans {spans}", make).withColumnRenamed("id", id_column)


def spans_text(column: str) -> Column:
    """kind:start:end of each span, comma-joined, in the order found."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def n_spans(column: str, kind: str) -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long")


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are replaced as one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_pii(docs: DataFrame, weights: Weights, text_column: str = "text") -> DataFrame:
    """`docs` with every span masked; null texts stay null, all other columns stay as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    schema = docs.schema
    names = schema.fieldNames()

    def run(batches):
        import pyarrow as pa
        for batch in in_parts(batches):
            texts = [t if t is None else mask(t, all_spans(t, sent.value)[1])
                     for t in batch.column(text_column).to_pylist()]
            kind = batch.schema.field(text_column).type
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, kind) if n == text_column else batch.column(n) for n in names], names=names)

    return docs.mapInArrow(run, schema)
