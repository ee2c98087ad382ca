"""Token counts and packing against the libraries, and the packing plan against its bounds."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tests.llm.conftest import awkward_rows, prose
from tokenizers import Tokenizer

from sparkloom.llm import packing, token_counts

ODD = [" a", " ", "  ", "   b", "a  b", "a b ", "a  ", "\n x \n", "a▁b", " ▁", "<s> a</s> <unk>", "日本 語 x", "a\x00b c",
       "x<|endoftext|>y", " x <|endoftext|> y", "it's 's", "a\x1cb", "é x", "😀 😀", " a"]


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_counts_equal_the_library(spark, frame, awkward, no_docs, name):
    path = public_tokenizers.path(name)
    texts = dict(enumerate(ODD + [prose(k, 50) for k in range(30)] + ["", None]))
    got = {r.doc_id: r for r in token_counts.count_tokens(frame(texts.items()), path, frequent=20).collect()}
    if name.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = {k: len(model.encode(t or "")) for k, t in texts.items()}
    else:
        model = Tokenizer.from_file(path)
        want = {k: len(model.encode(t or "", add_special_tokens=False).ids) for k, t in texts.items()}
    assert {k: r.n_tokens for k, r in got.items()} == want
    assert all(r.n_bytes == len((texts[k] or "").encode()) for k, r in got.items())
    assert token_counts.count_tokens(awkward, path).count() == 12
    assert token_counts.count_tokens(no_docs, path).collect() == []


def test_ids_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ODD + [prose(k, 200) for k in range(20)] + [""]
    library = Tokenizer.from_file(path)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert packing.Encoder(path).encode(texts) == want


def test_ids_of_very_long_runs_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    long = packing.LONG_SPACE
    texts = ["\n" * 2_000_000, "a" + " \n" * 1_000_000 + "b", "x" + "\u00a0" * 1_200_000, " " * (long - 1) + "x",
             "x" + " " * long, "a" * 300_000, "ab \n" * 50_000]
    library = Tokenizer.from_file(path)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert packing.Encoder(path).encode(texts) == want


def _check_plan(histogram, capacity):
    rows = packing.plan(histogram, capacity)
    used, fill = Counter(), {}
    for length, first, n, sequence, offset in rows:
        assert n > 0 and first == used[length]
        used[length] += n
        for s in range(sequence, sequence + n):
            fill.setdefault(s, []).append((offset, length))
    assert all(used[k] == histogram[k] for k in range(1, capacity + 1))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(fill) == set(range(len(fill)))
    return len(fill)


def test_plan_is_whole_and_near_the_bound():
    draw = np.random.default_rng(2)
    for lengths, slack in ((draw.integers(1, 65, 4000), 1.02), (np.clip(draw.lognormal(3, .6, 3000), 1, 64).astype(int), 1.03),
                           (np.full(50, 40), 2.0), (np.array([64, 64, 1]), 1.5), (np.zeros(0, int), 1.0)):
        histogram = np.bincount(lengths, minlength=65)
        n = _check_plan(histogram, 64)
        assert n <= max(1, -(-lengths.sum() // 64)) * slack


def test_best_fit_runs_are_best_fit_decreasing():
    draw = np.random.default_rng(4)
    for _ in range(20):
        lengths = draw.integers(1, 33, draw.integers(1, 200))
        bins = []
        for length in sorted(lengths, reverse=True):
            fits = [k for k, gap in enumerate(bins) if gap >= length]
            if fits:
                bins[min(fits, key=lambda k: bins[k])] -= length
            else:
                bins.append(32 - length)
        runs = packing.best_fit_runs(np.bincount(lengths, minlength=33), 32)
        assert sum(n for _, n in runs) <= len(bins) + 1


def test_pack_round_trip(spark, frame, no_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = {k: prose(k, 1 + 13 * k) for k in range(60)} | {100: None, 101: "", 102: prose(5, 900)}
    rows = packing.pack(frame(texts.items()), path, capacity=128).collect()
    library, by_doc = Tokenizer.from_file(path), {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(texts)
    for k, pieces in by_doc.items():
        ids = library.encode(texts[k] or "", add_special_tokens=False).ids + [2]
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert all(r.length == 128 for r in pieces[1:])
        at = 0
        for r in pieces:
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // 128) * 1.1 + 1
    assert packing.pack(no_docs, path).collect() == []


def test_pack_awkward_rows(awkward):
    rows = packing.pack(awkward, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert len([r for r in rows if r.doc_id == 4]) == 2  # a repeated row is packed twice
    assert {r.doc_id for r in rows} == {r[0] for r in awkward_rows()}
    assert [r.length for r in rows if r.doc_id in (1, 2)] == [1, 1]
