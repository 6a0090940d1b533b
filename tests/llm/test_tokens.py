from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tendero.llm import tokens
from tests.llm.conftest import EDGES, rows_of

P = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
MODEL = P.path("piece_bpe_32k.model")
CASES = [
    "", " ", "  a  b ", "\nfoo\n\n bar", "a▁b ▁▁c", "<s> x</s> <0x0A>", "①②é́ﬁ", "a" * 70, "!!!??,,,a,b;c", "漢字かな 🎉🎉x",
    "\x00\x00a", "\t\tx\r\ny", "The quick brown-fox: 12,345.67 (approx.) isn't it?", "Aujourd'hui l'été", "x" * 40 + "é" * 9,
]


@pytest.fixture(scope="module")
def encoder():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_every_prefix_has_the_library_count(encoder):
    counter = tokens.PrefixCounter(MODEL)
    for text in CASES:
        counts = tokens.prefix_counts(counter.steps(text)).tolist()
        assert counts == [len(encoder.encode(text[:k])) for k in range(len(text) + 1)], text


def test_tables_stay_exact_when_they_overflow(encoder, monkeypatch):
    for limit in ("CHUNK_LIMIT", "PART_LIMIT", "PAIR_LIMIT", "SHARED_LIMIT"):
        monkeypatch.setattr(tokens, limit, 3)
    counter = tokens.PrefixCounter(MODEL)
    for text in CASES * 2:
        assert tokens.prefix_counts(counter.steps(text))[-1] == len(encoder.encode(text))


def test_edge_rows(corpus, encoder):
    found = tokens.token_counts(corpus(EDGES, clashing=True), MODEL, limit=10)
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in rows_of(found))
    want = sorted((i or 0, len((t or "").encode()), len(encoder.encode(t or ""))) for i, t in EDGES)
    assert got == want
    assert tokens.token_counts(corpus([]), MODEL).count() == 0


def test_budget_questions_from_the_stored_steps(corpus, encoder):
    text = CASES[12]
    counted = tokens.token_counts(corpus([(1, text)]), MODEL, limit=5).withColumn("at", F.lit(11)).withColumn("budget", F.lit(7))
    row = tokens.truncated(tokens.tokens_at(counted, "at", "n_at"), "budget", "cut").first()
    assert row.n_at == len(encoder.encode(text[:11]))
    within = lambda most: max(k for k in range(len(text) + 1) if len(encoder.encode(text[:k])) <= most)
    assert row.cut == within(7) and row.limit_chars == within(5)


def test_tasks_of_a_worker_share_the_chunks_they_met():
    counter = tokens._counter(MODEL)
    counter.steps("one two")
    assert tokens._counter(MODEL) is counter and {"▁one", "▁two"} <= counter.chunks.keys()


def test_beginnings_hold_no_tuples_and_stay_exact(encoder):
    counter = tokens.PrefixCounter(MODEL)
    for text in ("unbelievable", "unbelief", "un", "unbelievably-long.and so on", "ﷺ①é" * 9):
        counts = tokens.prefix_counts(counter.steps(text)).tolist()
        assert counts == [len(encoder.encode(text[:k])) for k in range(len(text) + 1)], text
    # One record serves all beginnings that were met together.
    shared = counter.chunks.shared
    assert all(type(x) is bytes for x in shared.values()) and shared["▁unb"] is shared["▁unbelie"]
