from __future__ import annotations

import random

import pytest

from tendero.llm import urls
from tendero.llm.registry import URL_RULES
from tests.llm.conftest import rows_of

CASES = [
    None, "", "no scheme", "http://", "http://Example.ORG/es/x?y=1#z", "https://a.example.org/en/17", "http://notexample.org/es/1",
    "http://example.org", "http://example.org?x=/es/", "http://x.com/fr/9", "http://x.com/de/9", "http://com/de/9", "http://x.net/de/9",
    "http://example.org/en/2", "http://ÄB.org/ü", "a://b://c/d", "http://example.org:80/es/1", "http://x.com/fr", "http://h.net/" + "a/" * 5000,
]


def parts(url):
    rest = (url or "").partition("://")[2]
    at = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[at:]
    end = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return rest[:at].translate(str.maketrans(urls.UPPER, urls.LOWER)), path[:end]


def longest(host, path):
    best = None
    for rule in URL_RULES:
        own, slash, start = rule.text.partition("/")
        fits = (host == own or host.endswith("." + own)) and path.startswith(slash + start)
        if fits and (best is None or len(rule.text) > len(best.text)):
            best = rule
    return best


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, score string, suffix string")


@pytest.fixture(scope="module")
def known(labels):
    rng = random.Random(1)
    rows, marks = [], []
    for k in range(600):
        bad = rng.random() < 0.4
        tail = "?a=1&b=2&c=3&d=4" if bad else ""
        rows.append((k, f"http://h{rng.randint(1, 9)}.example.net/en/{k}{tail}"))
        marks.append((k, int(not bad), 0))
    return rows, marks


def test_parts_rules_and_edges(spark, labels, known):
    rows = known[0] + [(1000 + k, u) for k, u in enumerate(CASES)] + [(None, None), (1000, None)]
    found = rows_of(urls.url_filter(pages_of(spark, rows), labels([*known[1], (None, 1, 0), (5, None, 0)]), URL_RULES, rounds=3))
    assert len(found) == len(rows)
    by_id = {r["page_id"]: r for r in found}
    for k, url in enumerate(CASES):
        r = by_id[1000 + k]
        host, path = parts(url)
        rule = longest(host, path)
        assert (r["host"], r["path"]) == (host, path), url
        assert r["rule"] == (rule and rule.text), url
        assert r["verdict"] == (rule.verdict if rule else "block" if r["score"] >= 0.5 else "allow")


def test_trees_learn_a_lexical_mark(spark, labels, known):
    rows, marks = known
    found = {r["page_id"]: r["verdict"] for r in rows_of(urls.url_filter(pages_of(spark, rows), labels(marks), URL_RULES))}
    right = [found[k] == ("allow" if good else "block") for k, good, _ in marks]
    assert sum(right) == len(right)


def test_features_are_lexical(spark):
    frame = urls.with_parts(pages_of(spark, [(1, "http://ab.example.com/a/b/12?x=1&y=2#top")]))
    row = frame.select(*(c.alias(k) for k, c in urls.features().items())).first()
    assert (row.depth, row.parameters, row.labels, row.fragment) == (3, 2, 2, 1)


def test_only_native_operators(spark, labels, known):
    frame = urls.url_filter(pages_of(spark, known[0]), labels(known[1]), URL_RULES, rounds=2)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_without_labels_or_pages(spark, labels):
    found = rows_of(urls.url_filter(pages_of(spark, [(1, "http://a.net/x")]), labels([]), URL_RULES))
    assert found[0]["verdict"] == "allow"
    assert urls.url_filter(pages_of(spark, []), labels([(1, 1, 0)]), URL_RULES).count() == 0
