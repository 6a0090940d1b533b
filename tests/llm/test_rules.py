from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np

from tendero.llm import rules
from tests.llm.conftest import EDGES, prose, rows_of


def brute(text):
    words = rules.WORD.findall(text)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + d for k in range(len(words) - 4) for d in range(5) if windows[tuple(words[k : k + 5])] > 1}
    lines = [x for x in text.split("\n") if rules.WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_against_brute_force():
    rng = random.Random(1)
    texts = [t or "" for _, t in EDGES if len(t or "") < 1000]
    for _ in range(200):
        texts.append("".join(rng.choice(["a ", "b ", "c ", "\n", "d# ", "é\t", "x\u00a0y "]) for _ in range(rng.randint(0, 60))))
    for text in texts:
        assert rules.counts_of(text)[:5] == brute(text)


def test_binomial_tail_is_exact():
    for n, p in ((1, 0.3), (20, 0.1), (50, 0.02)):
        for k in range(n + 1):
            want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert abs(rules.binomial_tail(k, n, p) - want) < 1e-12


def test_cutoffs_keep_the_false_rejection_rate():
    """Over many samples, the true rate is above alpha no more often than delta says."""
    rng = np.random.default_rng(4)
    share = np.linspace(1, 0, rules.GRID + 1) ** 3
    share /= share.sum()
    above = share[::-1].cumsum()[::-1][1:]
    failures = 0
    for _ in range(200):
        good = rng.multinomial(3000, share)
        cutoff = rules.choose(good, rng.multinomial(500, share[::-1]), 0.01, 0.1)
        failures += cutoff is not None and above[cutoff] > 0.01
    assert failures <= 0.1 * 200 + 12


def test_too_few_labels_give_no_cutoff():
    good, bad = np.zeros(rules.GRID + 1, int), np.zeros(rules.GRID + 1, int)
    good[0], bad[150] = 50, 20
    assert rules.choose(good, bad, 0.004, 0.01) is None
    good[0] = 5000
    assert 0 <= rules.choose(good, bad, 0.004, 0.01) < 149


def test_the_sequence_keeps_the_rate_from_few_labels():
    """The whole procedure over many samples of 260 good labels: laid out by a fifth, tested by the rest."""
    rng = np.random.default_rng(7)
    features, failures, decided = 3, 0, 0
    good_share = np.stack([np.linspace(1, 0, rules.GRID + 1) ** p for p in (8, 20, 40)])
    good_share /= good_share.sum(axis=1, keepdims=True)

    def draw(share, n):
        return np.stack([rng.choice(rules.GRID + 1, n, p=row) for row in share])

    def histogram(levels):
        return np.stack([np.bincount(row, minlength=rules.GRID + 1) for row in levels])

    many = draw(good_share, 100_000)
    for _ in range(150):
        shape, held, bad = draw(good_share, 52), draw(good_share, 208), draw(good_share[:, ::-1], 40)
        moves = rules.sequence(histogram(shape), histogram(bad))
        first = lambda levels: np.array(
            [max((len(moves) - k for k, (f, c) in enumerate(moves) if x[f] > c), default=0) for x in levels.T]
        )
        by_place = [np.bincount(first(x), minlength=len(moves) + 1) for x in (held, bad)]
        cutoff = rules.choose(*by_place, 0.02, 0.1)
        if cutoff is not None:
            decided += 1
            last = dict(moves[: len(moves) - cutoff])
            lost = np.zeros(many.shape[1], bool)
            for f, c in last.items():
                lost |= many[f] > c
            failures += lost.mean() > 0.02
    assert features == len(good_share) and decided > 100
    assert failures <= 0.1 * 150 + 11


def test_sequence_takes_the_best_catch_first_and_only_tightens():
    good, bad = np.zeros((2, rules.GRID + 1), int), np.zeros((2, rules.GRID + 1), int)
    good[0, :100], good[1, :20] = 1, 5
    bad[0, 90:], bad[1, 150:160] = 1, 9
    moves = rules.sequence(good, bad)
    assert moves[0] == (1, 149)
    for feature in (0, 1):
        steps = [step for f, step in moves if f == feature]
        assert steps == sorted(steps, reverse=True) and len(set(steps)) == len(steps)
    assert rules.sequence(good, np.zeros_like(bad)) == []


def test_every_stratum_with_enough_labels_decides(corpus, labels):
    rng = random.Random(3)
    rows, known = [], []
    for k in range(1200):
        good = k % 5 != 0
        words = prose(rng, 14).split()
        rows.append((k, " ".join(words if good else [f"{w}###" for w in words]), ("en", "de", None)[k % 3] if k < 1170 else "fr"))
        known.append((k, int(good), 0))
    measured = rules.measure(corpus(rows, clashing=True))
    found = rules.calibrate(measured, labels([*known, (None, 1, 0), (3, None, 0), (4, 1, 0)]))
    assert sorted(found) == ["", "de", "en"]
    judged = {r["doc_id"]: r["kept"] for r in rows_of(rules.judge(measured, found))}
    assert all(judged[k] == bool(label) or rows[k][2] == "fr" for k, label, _ in known)


def test_junk_goes_and_good_texts_stay(corpus, labels):
    rng = random.Random(2)
    rows, known = [], []
    for k in range(2600):
        good = k % 13 != 0
        words = prose(rng, 14).split()
        rows.append((k, " ".join(words if good else [f"{w}###" for w in words])))
        known.append((k, int(good), 0))
    edges = [(None if d is None else 10_000 + d, t, None) for d, t in EDGES]
    docs = corpus(rows + edges, clashing=True)
    found = rows_of(rules.quality_rules(docs, labels(known)))
    assert len(found) == len(rows) + len(edges)
    for r in found:
        base = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == base and not (base and r["kept"])
        if r["doc_id"] is not None and r["doc_id"] < 10_000:
            assert r["kept"] == bool(known[r["doc_id"]][1])
    accepted = rules.accepted(docs, labels(known))
    assert accepted.columns == docs.columns
    assert sorted(str(r.doc_id) for r in accepted.collect()) == sorted(str(r["doc_id"]) for r in found if r["kept"])


def test_without_labels_only_the_fixed_rules_hold(corpus, labels):
    docs = corpus([(1, "### " * 12), (2, prose(random.Random(1), 12)), (3, None)])
    found = {r["doc_id"]: r["kept"] for r in rows_of(rules.quality_rules(docs, labels([])))}
    assert found == {1: False, 2: True, 3: False}
    assert rules.quality_rules(corpus([]), labels([(1, 1, 0)])).count() == 0
