from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tendero.llm import suffixes
from tests.llm.conftest import rows_of


def brute(texts, length):
    """(removed, spans, kept) of each text."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(g and not before for before, g in zip(b"\0" + gone, gone, strict=False))
        out.append((sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def test_suffix_array_and_common_prefixes_against_sorting():
    rng = random.Random(1)
    for trial in range(150):
        symbols = rng.choice([2, 3, 200])
        t = [rng.randint(1, symbols) for _ in range(rng.randint(1, 70))] * rng.choice([1, 1, 3]) + [0]
        array = suffixes.suffix_array(np.array(t), 258)
        assert array.tolist() == sorted(range(len(t)), key=lambda k: t[k:]), trial
        before, common = suffixes.permuted_common_prefixes(np.array(t), array)
        for a, b in zip(array[1:], array[:-1], strict=True):
            n = next((k for k in range(len(t)) if max(a, b) + k >= len(t) or t[a + k] != t[b + k]))
            assert (before[a], common[a]) == (b, n)


def test_many_names_end_in_doubling():
    rng = np.random.default_rng(2)
    t = np.r_[rng.integers(1, 5000, 3000), rng.integers(1, 5000, 50), 0]
    t[100:600] = t[1000:1500]
    assert suffixes.suffix_array(t, 5001).tolist() == sorted(range(len(t)), key=lambda k: t[k:].tolist())


def test_equal_strings_have_equal_anchors():
    rng = random.Random(3)
    shared = bytes(rng.randrange(256) for _ in range(300))
    seen = []
    for size in (10, 77):
        text = bytes(rng.randrange(256) for _ in range(size)) + shared + bytes(rng.randrange(256) for _ in range(size))
        found = {}
        for anchor, first, last in suffixes.anchored_runs(text, 100, 16):
            for start in range(first, last + 1):
                found[start - size] = anchor
        assert set(found) == set(range(-size, len(shared) + size - 99))
        seen.append([found[k] for k in range(201)])
    assert seen[0] == seen[1]


@pytest.mark.parametrize("most_kinds", [4096, 2])
def test_removal_against_brute_force(corpus, most_kinds):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passages = [word(rng.randint(35, 90)) for _ in range(4)]
    rows = [(None, passages[0] + "x"), (None, None), (1, None), (2, ""), (3, "short"), (4, "z" * 300), (5, passages[1]), (5, passages[1]), (5, "other" + passages[2])]
    for doc in range(10, 70):
        parts = [word(rng.randint(0, 60)), *rng.choices(passages, k=rng.randint(0, 2)), word(rng.randint(0, 60))]
        rng.shuffle(parts)
        rows.append((doc, "".join(parts)))
    docs = corpus(rows, clashing=True)
    found = rows_of(suffixes.without_repeats(docs, length=40, gram=8, most_kinds=most_kinds))
    want = Counter((d, len((t or "").encode()), *w) for (d, t), w in zip(rows, brute([t for _, t in rows], 40), strict=True))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found) == want


def test_texts_longer_than_a_chunk(monkeypatch):
    rng = random.Random(5)
    text = bytes(rng.randrange(4) for _ in range(900))
    whole = {s: a for a, f, l in suffixes.anchored_runs(text, 60, 8) for s in range(f, l + 1)}
    monkeypatch.setattr(suffixes, "CHUNK", 100)
    assert {s: a for a, f, l in suffixes.anchored_runs(text, 60, 8) for s in range(f, l + 1)} == whole


def test_memory_of_a_suffix_array():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    runs = [" ".join(rng.choices(words, k=120)).encode()[:700] for _ in range(600)]
    runs[300:400] = runs[:100]
    suffixes.repeated_starts(runs[:2], 400)  # what the first call loads does not count
    tracemalloc.start()
    try:
        found = suffixes.repeated_starts(runs, 400)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(map(len, found)) == 200 * (len(runs[0]) - 399)
    assert peak < 60 * sum(map(len, runs))


def test_an_array_takes_whole_anchors_up_to_a_size():
    sizes = {1: [30, 30], 2: [40], 3: [1], 4: [70, 70], 5: [10], 6: [90], 7: [1]}
    rows = [(k, 0, anchor, 0, bytes(n)) for anchor, held in sizes.items() for k, n in enumerate(held)]
    found = list(suffixes.by_array(iter(rows), 100))
    assert [row for held in found for row in held] == rows
    assert [sorted({row[2] for row in held}) for held in found] == [[1, 2], [3], [4], [5, 6], [7]]
    assert list(suffixes.by_array(iter(()), 100)) == []


def test_empty_table(corpus):
    assert suffixes.without_repeats(corpus([])).count() == 0
