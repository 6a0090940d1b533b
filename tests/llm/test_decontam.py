from __future__ import annotations

import random

import pytest

from tendero.llm import decontam
from tendero.llm.decontam import Budget
from tests.llm.conftest import EDGES, prose, rows_of


def edits_within(segment, text):
    """The fewest edits between the segment and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(segment, 1):
        after = [i]
        for j, b in enumerate(text, 1):
            after.append(min(row[j - 1] + (a != b), row[j] + 1, after[-1] + 1))
        row = after
    return min(row)


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        kind, at = rng.random(), rng.randrange(len(out))
        if kind < 0.4:
            out[at] = rng.choice("xyz")
        elif kind < 0.7:
            del out[at]
        else:
            out.insert(at, rng.choice("xyz "))
    return "".join(out)


def index_of(items, budget=Budget()):  # noqa: B008
    index = decontam.Index(budget)
    for item, text in items:
        index.add(item, text)
    return index.close()


def test_finds_exactly_what_the_edit_distance_finds():
    rng = random.Random(1)
    items = [(k, prose(rng, rng.randint(6, 40))) for k in range(12)]
    index = index_of(items)
    for trial in range(120):
        _, text = items[trial % 12]
        cut = decontam.plain(text)[:100]
        doc = prose(rng, 12) + " " + changed(rng, cut, rng.randint(0, 14)) + " " + prose(rng, 12)
        want = {
            index.segments[s][0]
            for s in range(len(index.segments))
            if edits_within(index.segments[s][2], decontam.plain(doc)) <= index.allowed[s]
        }
        assert {m[0] for m in decontam.matches(index, doc)} == want


def test_case_and_white_space_do_not_matter():
    rng = random.Random(2)
    text = prose(rng, 30)
    index = index_of([(1, text)])
    assert decontam.matches(index, "x\n" + text.upper().replace(" ", "\t") + "\ny")[0][3] == 0


def test_runs_of_white_space_are_one_blank():
    rng = random.Random(4)
    text = prose(rng, 55)
    given = f"x  \n {text.upper().replace(' ', '  ')}\t\ty"
    (item, start, end, edits, _), = decontam.matches(index_of([(1, text)]), given)
    assert (item, edits) == (0, 0) and given[start:end] == text.upper().replace(" ", "  ")
    spaced = index_of([(1, text.replace(" ", " \n "))])
    assert decontam.matches(spaced, f"a {text} b")[0][1:4] == (2, 2 + len(text), 0)


def test_quotes_of_thirteen_words_at_all_offsets():
    rng = random.Random(5)
    text = prose(rng, 60)
    index, words = index_of([(1, text)]), text.split()
    for k in range(len(words) - 12):
        quote = " ".join(words[k : k + 13])
        assert [m[0] for m in decontam.matches(index, f"{prose(rng, 10)} {quote} {prose(rng, 10)}")] == [0], k
    unspaced = "".join(rng.choice("abcdefghij") for _ in range(400))
    index = index_of([(1, unspaced)])
    for k in range(len(unspaced) - 108):
        assert decontam.matches(index, f"{prose(rng, 10)}-{unspaced[k : k + 109]}-{prose(rng, 10)}"), k
    assert not decontam.matches(index, prose(rng, 300))


@pytest.mark.parametrize("block_chars", [1, 200, 1_000_000])
def test_rows_blocks_and_edges(corpus, spark, block_chars):
    rng = random.Random(3)
    items = [(1, prose(rng, 40)), (2, prose(rng, 20)), (3, None), (4, ""), (5, "tiny"), (None, prose(rng, 25)), (2, "ab")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [*EDGES, (20, f"a {items[0][1]} b"), (21, f"a {items[5][1]} b tiny"), (21, f"a {items[5][1]} b tiny"), (22, prose(rng, 200))]
    docs = corpus(rows, clashing=True)
    found = rows_of(decontam.contamination(docs, benchmark, block_chars=block_chars))
    got = sorted((r["doc_id"], r["item_id"] or 0) for r in found if r["doc_id"] and r["doc_id"] >= 20)
    extra = [(22, 2)] if "ab" in rows[-1][1] else []
    assert [g for g in got if g[1] != 2] == [(20, 1), (21, 0), (21, 0), (21, 5), (21, 5)] and set(extra) <= set(got)
    kept = decontam.decontaminate(docs, spark.createDataFrame(items[:2], benchmark.schema), block_chars=block_chars)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in rows if d != 20)


def test_empty_tables(corpus, spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(corpus(EDGES), benchmark).count() == 0
    assert decontam.decontaminate(corpus(EDGES), benchmark).count() == len(EDGES)
    assert decontam.contamination(corpus([]), benchmark).count() == 0


def test_short_items_drop_only_whole_words(corpus, spark):
    benchmark = spark.createDataFrame([(1, "yes"), (2, "ab")], "item_id long, text string")
    docs = corpus([(1, "yesterday was about eyes"), (2, "They said: YES."), (3, "cab, ab")])
    assert [r.doc_id for r in decontam.decontaminate(docs, benchmark).collect()] == [1]
    assert decontam.contamination(docs, benchmark).where("doc_id = 1").count() == 2
