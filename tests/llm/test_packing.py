from __future__ import annotations

import random
import zlib
from array import array
from collections import Counter

import pytest

from tendero.llm import common, packing
from tests.llm.conftest import EDGES, prose, rows_of

P = pytest.importorskip("public_tokenizers")
Tokenizer = pytest.importorskip("tokenizers").Tokenizer
FILE = P.path("word_bpe_49k.json")


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_words_give_the_ids_of_whole_texts():
    tokenizer, words = Tokenizer.from_file(FILE), packing._Words(FILE)
    for text in ("<|endoftext|> a<|startoftext|>b", "e ́x", "\tA\x1cB\x85c\xa0d", "İI ΑΣ ΣΑ", "it's We'll 'S", "", "  ", "漢字 🎉\n\nx"):
        assert array("I", words.ids(text)).tolist() == ids_of(tokenizer, text)[:-1]


def test_tasks_of_a_worker_share_the_words_they_met():
    words = packing._words(FILE)
    words.ids("one two")
    assert packing._words(FILE) is words and {"one", "two"} <= words.words.keys()


def test_plan_fills_without_overlap_and_close_to_the_bound():
    rng = random.Random(1)
    for _ in range(60):
        counts = Counter(rng.randint(1, 40) for _ in range(rng.randint(1, 200)))
        plan = packing.best_fit(counts.items(), 40)
        seen = set()
        for length, low, high, first, offset in plan.slots:
            for sequence in range(first, first + high - low):
                cells = {(sequence, x) for x in range(offset, offset + length)}
                assert offset + length <= 40 and not cells & seen
                seen |= cells
        total = sum(k * n for k, n in counts.items())
        assert len(seen) == total and plan.sequences <= -(-total // 40) * 11 // 9 + 1
        fills = Counter(s for s, _ in seen)
        assert all((s, x) in seen for s, n in fills.items() for x in range(n))


def test_plan_does_not_depend_on_counts_in_size():
    small = packing.best_fit([(1500, 3), (700, 4), (548, 3)], 2048)
    large = packing.best_fit([(1500, 3 * 10**9), (700, 4 * 10**9), (548, 3 * 10**9)], 2048)
    assert len(large.slots) == len(small.slots) and large.sequences == small.sequences * 10**9
    with pytest.raises(ValueError):
        packing.best_fit([(2049, 1)], 2048)


def test_packed_pieces_against_brute_force(corpus):
    rng = random.Random(2)
    docs = EDGES + [(100 + k, prose(rng, rng.randint(0, 60))) for k in range(80)]
    tokenizer = Tokenizer.from_file(FILE)
    packed = packing.best_fit_packing(corpus(docs, clashing=True), FILE, length=64, with_ids=True).cache()
    want = Counter()
    for doc, text in docs:
        ids = ids_of(tokenizer, text)
        for n, start in enumerate(range(0, len(ids), 64)):
            part = ids[start : start + 64]
            want[doc, n, start, len(part), zlib.crc32(array("I", part).tobytes())] += 1
    rows = rows_of(packed)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], bytes(r["ids"])))
    for parts in by_sequence.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= -(-total // 64) + 2
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert whole == {s: b"".join(x for _, _, x in sorted(p)) for s, p in by_sequence.items()}


def test_empty_table(corpus):
    assert packing.best_fit_packing(corpus([]), FILE).count() == 0


def test_worker_lets_go_of_the_words_in_another_operator():
    class Rows:
        def mapInArrow(self, run, schema):
            return run

    words = packing._words(FILE)
    run = common.map_batches(Rows(), lambda: lambda batch: {"x": batch.column("x")}, "x long")
    assert not list(run(iter([]))) and packing._words(FILE) is not words


def test_words_stay_exact_and_bounded_when_the_table_is_full(monkeypatch):
    monkeypatch.setattr(packing, "WORD_LIMIT", 3)
    tokenizer, words = Tokenizer.from_file(FILE), packing._Words(FILE)
    long = "y" * 99 + "!!"
    for text in ("the One, two", "one. Two three", long, f"four {long} the One,", "One, five! six the", "seven the two") * 2:
        assert array("I", words.ids(text)).tolist() == ids_of(tokenizer, text)[:-1]
        assert len(words.words) + len(words.old) < 30 and not any(len(x) > 64 for x in {*words.words, *words.old})
    assert "the" in words.words
