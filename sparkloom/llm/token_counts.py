"""Token counts by a map-side two-tier lookup.

Tier one is a compact table of frequent pre-tokens and their token counts, broadcast to all workers. Tier
two is a bounded cache in each worker; what it misses is encoded by the tokenizer library. No pre-token is
shuffled while texts are counted. Only which words are in tier one depends on a sample, never a count.

Sentencepiece models: a text is cut where a space follows another character. The pieces of the model hold
no space after another character, so no merge crosses such a cut (checked when the table is built), and a
part with its space is encoded as it is inside the text. Models of the tokenizers library, and sentencepiece models for which
the check fails, are counted by the library text by text.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import map_batches, texts_of

#: The meta symbol by which sentencepiece writes a space.
SPACE = "▁"


def can_cut_at_spaces(model_path: str) -> bool:
    """True if no merge of the model crosses a space that follows another character, and the text is not
    rewritten before encoding; then counts of parts add up."""
    from sentencepiece import sentencepiece_model_pb2 as model_pb2
    model = model_pb2.ModelProto()
    with open(model_path, "rb") as file:
        model.ParseFromString(file.read())
    spec = model.normalizer_spec
    plain = (spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.escape_whitespaces
             and not spec.precompiled_charsmap)
    own = [p.piece for p in model.pieces if p.type in (1, 4)]
    crossing = any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in own)
    return plain and not crossing and not any(p.type == 4 for p in model.pieces)


def parts_of(text: str) -> list[str]:
    """The text cut at every single space; runs of spaces stay at the head of the part after them.

    A part is the text without its first space, which sentencepiece's dummy prefix puts back; for a part
    that begins with more spaces those beyond the first stay.
    """
    parts = text.split(" ")
    if "" not in parts:
        return parts
    joined, spaces = [], 0
    for k, part in enumerate(parts):
        if part == "" and k + 1 < len(parts):
            spaces += 1
            continue
        joined.append(" " * spaces + part)
        spaces = 0
    return joined


class Counter:
    """Counts the tokens of whole texts; misses of both tiers go to the library, a batch of texts at once."""

    def __init__(self, encode_lengths, frequent: tuple[bytes, np.ndarray] | None, limit: int = 300_000):
        self._encode_lengths, self._limit = encode_lengths, limit
        # An empty part stands for one space at a text's end, which the library cannot be given alone.
        with_space, without = encode_lengths(["a ", "a"])
        self._known: dict[str, int] = {"": with_space - without}
        if frequent is not None and len(frequent[1]):
            self._known.update(zip(frequent[0].decode().split("\x00"), frequent[1].tolist()))
        self._own = 0

    def count(self, texts: list[str]) -> list[int]:
        known, total, waiting = self._known, [0] * len(texts), {}
        for k, text in enumerate(texts):
            if not text:
                continue
            found = list(map(known.get, parts := parts_of(text)))
            if None in found:
                for part, n in zip(parts, found):
                    if n is None:
                        waiting.setdefault(part, []).append(k)
                total[k] = sum(n for n in found if n is not None)
            else:
                total[k] = sum(found)
        if waiting:
            missed = list(waiting)
            for part, n in zip(missed, self._encode_lengths(missed)):
                for k in waiting[part]:
                    total[k] += n
                if self._own < self._limit and len(part) <= 256:
                    known[part] = n
                    self._own += 1
        return total


def _sentencepiece_lengths(model_path: str):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return lambda parts: [len(ids) for ids in model.encode(parts, num_threads=1)]


def frequent_parts(texts: DataFrame, model_path: str, keep: int, sample_rows: int) -> tuple[bytes, np.ndarray]:
    """Compact table of the `keep` most frequent parts of about `sample_rows` rows, with their counts.

    It only decides what is looked up instead of encoded. At most `keep` short words reach the driver.
    """
    rows = texts.count()
    if not rows:
        return b"", np.empty(0, np.uint8)
    some = texts.sample(min(1.0, sample_rows / rows), seed=5)
    top = (some.select(F.explode(F.split("text", " ")).alias("part"))
           .filter((F.length("part") > 0) & (F.length("part") <= 64) & ~F.col("part").contains("\x00"))
           .groupBy("part").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "part").limit(keep))
    parts = [r.part for r in top.select("part").collect()]
    lengths = _sentencepiece_lengths(model_path)(parts)
    return "\x00".join(parts).encode(), np.array(lengths, np.uint16)


def count_tokens(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text",
                 frequent: int = 50_000, sample_rows: int = 2_000) -> DataFrame:
    """(id, n_bytes, n_tokens) of every whole text, null as empty: 0 bytes, 0 tokens; one pass, no shuffle.

    `model_path` names a sentencepiece .model or a tokenizers .json file that every worker can read.
    Repeated rows are each counted; an empty table gives no rows; other columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    cut = model_path.endswith(".model") and can_cut_at_spaces(model_path)
    table = None
    if cut:
        found = frequent_parts(narrow.select("text").filter(F.length("text") > 0), model_path, frequent, sample_rows)
        table = docs.sparkSession.sparkContext.broadcast(found)

    def make():
        if cut:
            count = Counter(_sentencepiece_lengths(model_path), table.value).count
        elif model_path.endswith(".model"):
            count = _sentencepiece_lengths(model_path)
        else:
            from tokenizers import Tokenizer
            tokenizer = Tokenizer.from_file(model_path)
            tokenizer.no_truncation()
            tokenizer.no_padding()

            def count(texts):
                return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

        def fill(batch):
            texts = texts_of(batch)
            n_tokens = []
            for start in range(0, len(texts), 500):
                n_tokens += count(texts[start:start + 500])
            return batch.column("id"), [len(t.encode()) for t in texts], n_tokens
        return fill

    return (map_batches(narrow, f"id {kind}, n_bytes bigint, n_tokens bigint", make)
            .withColumnRenamed("id", id_column))
