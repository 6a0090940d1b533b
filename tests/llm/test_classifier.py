from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tendero.llm import classifier
from tests.llm.conftest import EDGES, prose, rows_of


def marked(rng, good):
    words = prose(rng, rng.randint(8, 40)).split()
    return " ".join(words if good else [w + rng.choice(["%%%", "$$$"]) for w in words])


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(3)
    kinds = [rng.random() < 0.8 for _ in range(400)]
    return [(k, marked(rng, good)) for k, good in enumerate(kinds)], [(k, int(good), 0) for k, good in enumerate(kinds)]


def test_held_out_accuracy_and_edges(corpus, labels, labelled):
    rows, known = labelled
    edges = [(None if d is None else 10_000 + d, t) for d, t in EDGES]
    known = [*known, (None, 1, 0), (0, None, 0), (10_006, 1, 0), (10_006, 0, 1)]
    found = rows_of(classifier.quality_scores(corpus(rows + edges, clashing=True), labels(known)))
    assert len(found) == len(rows) + len(edges)
    truth = {k: y for k, y, _ in known if k is not None and k < 400}
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert held and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        out = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["held_out"] == out


def test_labels_of_held_out_rows_do_not_matter(corpus, labels, labelled):
    rows, known = labelled
    turned = [(k, 1 - y if zlib.crc32(str(k).encode()) % 5 == 0 else y, t) for k, y, t in known]
    docs = corpus(rows)
    a, b = (sorted((r["doc_id"], r["score"]) for r in rows_of(classifier.quality_scores(docs, labels(x)))) for x in (known, turned))
    assert a == b


def test_dual_coordinate_descent_meets_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.array([0, 1], np.int32)] * 60
    x = rng.normal(size=(60, 2)) + np.repeat([[1.5, 1.5], [-1.5, -1.5]], 30, axis=0)
    y = np.repeat([1.0, -1.0], 30)
    w, bias = classifier.dual_coordinate_descent(rows, list(x), y, 2, passes=500)

    def loss(w, bias):
        return 0.5 * (w @ w + bias**2) + np.maximum(0, 1 - y * (x @ w + bias)).sum()

    best = min(loss(w + d[:2], bias + d[2]) for d in rng.normal(scale=0.05, size=(300, 3)))
    assert loss(w, bias) <= best + 1e-3


def test_ratios_are_log_counts():
    rows = [np.array([1, 2]), np.array([1]), np.array([2])]
    ratios = classifier.log_count_ratios(rows, np.array([True, True, False]))
    assert ratios[1] == pytest.approx(np.log(3 / 4) - np.log(1 / 3))
    assert ratios[2] == pytest.approx(np.log(2 / 4) - np.log(2 / 3))


def test_one_class_no_labels_and_empty_tables(corpus, labels):
    docs = corpus([(1, "a b c"), (2, None)])
    for known in ([], [(1, 1, 0)]):
        assert all(r["predicted"] == 1 for r in rows_of(classifier.quality_scores(docs, labels(known))))
    assert classifier.quality_scores(corpus([]), labels([(1, 1, 0)])).count() == 0
