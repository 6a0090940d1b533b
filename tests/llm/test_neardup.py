from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest

from tendero.llm import neardup
from tendero.llm.neardup import Sketching
from tests.llm.conftest import EDGES, prose, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").translate(neardup.LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(set size, smallest reachable id) of each row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    least = {}
    for (doc, _), own in zip(rows, label, strict=True):
        if doc is not None:
            least[own] = min(doc, least.get(own, doc))
    return [(doc, len(s), least.get(own)) for (doc, _), s, own in zip(rows, sets, label, strict=True)]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def near_copies(seed, groups, copies, words=60, edits=6):
    rng = random.Random(seed)
    rows, doc = [], 0
    passage = prose(rng, 55)
    for _ in range(groups):
        base = prose(rng, rng.randint(5, words)).split()
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = prose(rng, 1)
            text = " ".join(own)
            if rng.random() < 0.3:
                text = f"{passage} {text}"
            rows.append((doc, text.upper() if rng.random() < 0.1 else text))
            doc += 3
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("short_list", [48, 3])
def test_classes_against_all_pairs(corpus, short_list):
    rows = near_copies(1, 25, 12) + EDGES[:-2]
    docs = corpus(rows, clashing=True)
    found = rows_of(neardup.near_duplicates(docs, Sketching(short_list=short_list)))
    assert key((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == key(brute(rows))
    for r in found:
        if r["doc_id"] is not None:
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_one_large_group_of_near_copies(corpus):
    rng = random.Random(5)
    base = prose(rng, 80).split()
    rows = []
    for doc in range(150):
        own = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            own[rng.randrange(len(own))] = prose(rng, 1)
        rows.append((doc, " ".join(own)))
    found = rows_of(neardup.near_duplicates(corpus(rows)))
    assert key((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == key(brute(rows))


def test_representatives_keep_columns_and_one_of_each(corpus):
    rows = [(3, "one two three four five six"), (1, "one two three four five six"), (2, "another text altogether"), (2, "another text altogether"), (4, None), (5, "")]
    docs = corpus(rows, clashing=True)
    kept = neardup.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5]


def test_groups_without_an_id_keep_one_row(corpus):
    rng = random.Random(11)
    bases = [prose(rng, 60) for _ in range(3)]
    rows = [(None, f"{base} {prose(rng, 1)}") for base in bases for _ in range(8)]
    rows += [(None, bases[0])] * 3 + [(40, bases[2]), (None, prose(rng, 30))]
    found = rows_of(neardup.near_duplicates(corpus(rows)))
    assert key((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == key(brute(rows))
    assert sum(r["kept"] for r in found) == 4 and [r["doc_id"] for r in found if r["kept"] and r["component_id"]] == [40]
    kept = [(r.doc_id, r.text) for r in neardup.representatives(corpus(rows, clashing=True)).collect()]
    assert len(kept) == 4 and (40, bases[2]) in kept and rows[-1] in kept


def test_negative_ids_are_ids(corpus):
    rng = random.Random(12)
    base, other = prose(rng, 60), prose(rng, 60)
    rows = [(-5, base), (-7, f"{base} more"), (3, f"{base} less"), (-1, other), (None, f"{other} more"), (-(2**63), "by itself")]
    found = rows_of(neardup.near_duplicates(corpus(rows)))
    assert key((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == key(brute(rows))
    assert {r["doc_id"] for r in found if r["kept"]} == {-7, -1, -(2**63)}
    assert {r.doc_id for r in neardup.representatives(corpus(rows)).collect()} == {-7, -1, -(2**63)}


def test_one_id_on_several_texts(corpus):
    rng = random.Random(13)
    base, other = prose(rng, 60), prose(rng, 60)
    rows = [(6, base), (6, f"{base} more"), (6, other), (5, f"{other} more")]
    found = rows_of(neardup.near_duplicates(corpus(rows)))
    assert key((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == key(brute(rows))
    assert sorted(r.doc_id for r in neardup.representatives(corpus(rows)).collect()) == [5, 6]


def test_texts_with_equal_crc_are_told_apart(corpus):
    rows = [(None, "plumless"), (None, "buckeroo")]
    assert zlib.crc32(rows[0][1].encode()) == zlib.crc32(rows[1][1].encode())
    assert sorted(r.text for r in neardup.representatives(corpus(rows)).collect()) == ["buckeroo", "plumless"]


def test_components_of_long_chains(spark):
    chain = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 100), (7, 7)]
    found = neardup.components(spark.createDataFrame(chain, "a long, b long"))
    assert {(r.node, r.component) for r in found.collect()} == {(k, 0) for k in range(41)} | {(100, 100), (101, 100)}


def test_empty_tables(corpus):
    assert neardup.near_duplicates(corpus([])).count() == 0
    assert neardup.representatives(corpus([])).count() == 0


def test_group_of_near_copies_that_are_not_linked(corpus):
    """Copies of one text with similarities around and below the threshold, of several lengths."""
    rng = random.Random(21)
    base = prose(rng, 90).split()
    rows = []
    for doc in range(220):
        own = list(base)
        for _ in range(rng.randint(0, 12)):
            at = rng.randrange(len(own))
            own[at : at + 1] = rng.choice([[], [prose(rng, 1)], [own[at], prose(rng, 1)]])
        rows.append((doc, " ".join(own)))
    docs = corpus(rows)
    found = rows_of(neardup.near_duplicates(docs, Sketching(short_list=3)))
    assert key((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == key(brute(rows))
    assert 20 < sum(r["kept"] for r in found) < 200


def test_odd_bits_bound_the_difference():
    rng = random.Random(22)
    make = neardup.Shingles()
    for _ in range(50):
        x, y = (make(prose(rng, rng.randint(1, 400))) for _ in range(2))
        differ = sum(int(p ^ q).bit_count() for p, q in zip(neardup.odd_bits(x), neardup.odd_bits(y), strict=True))
        assert differ <= len(set(x.tolist()) ^ set(y.tolist()))
    assert not neardup.odd_bits(make("")).any()


def test_parities_rule_out_most_sets_a_little_below_the_threshold():
    rng, ruled_out = np.random.default_rng(7), 0
    for _ in range(100):  # 247 of 353 values in common: similarity 0.70
        x = rng.integers(0, 2**63, 353).astype(np.uint64)
        differ = int(np.bitwise_count(neardup.odd_bits(x[:300]) ^ neardup.odd_bits(x[53:])).sum())
        assert differ <= 106
        ruled_out += 7 * differ > 600
    assert ruled_out >= 90
