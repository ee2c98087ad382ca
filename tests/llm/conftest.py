"""Small awkward tables for all corpus operators."""

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use inside; they must neither be read nor disturb.
CLASHING = DOCS + ", id bigint, h string, score string, label string, bucket int, piece string, kept int, n int"

LONG = "word " * 60_000


def awkward_rows():
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (5, LONG), (6, LONG), (None, "no id here at all"),
            (7, "ünï çødé 日本 😀 a@b.example +1 (017) 555-7713 1.2.3.4"), (8, "The same words. " * 40),
            (9, "The same words. " * 40), (10, None)]
    return [(i, t, None, None, None, 0, "h", "s", "l", 1, "p", 2, 3) for i, t in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), CLASHING)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], CLASHING)


def prose(seed: int, words: int, vocabulary: int = 5000) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary):x}" for _ in range(words))


@pytest.fixture(scope="session")
def frame(spark):
    """(id, text) pairs as documents."""
    def make(pairs):
        return spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], DOCS)
    return make
