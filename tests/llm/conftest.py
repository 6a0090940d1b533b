from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that clash with names which the operators use inside.
CLASHING = "n long, kept string, digest string, size string, node string, component string, crc string, rank string, slot string"


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang)."""

    def build(rows, clashing=False):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        if not clashing:
            return spark.createDataFrame(rows, SCHEMA)
        return spark.createDataFrame([(*r, 7, *"abcdefgh") for r in rows], f"{SCHEMA}, {CLASHING}")

    return build


@pytest.fixture(scope="session")
def labels(spark):
    def build(rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return build


LONG = "lorem ipsum dolor " * 20_000
EDGES = [
    (None, "a text without an id and with some words"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, LONG),
    (5, "x" * 100_000),
    (6, "the same text twice in a row"),
    (6, "the same text twice in a row"),
    (7, "the same text twice in a row"),
    (8, "añoß 漢字 🎉"),
]


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(words))


def rows_of(df):
    return [r.asDict() for r in df.collect()]
