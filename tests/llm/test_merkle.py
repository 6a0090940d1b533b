from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tendero.llm import merkle
from tests.llm.conftest import EDGES, LONG, rows_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row) -> str:
    return digest(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in merkle.FIELDS])


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """The root, and for each leaf the siblings before and behind it, level by level."""
    paths, places = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for path, k in zip(paths, places):
            run = leaves[k // 3 * 3 : k // 3 * 3 + 3]
            path.append((run[: k % 3], run[k % 3 + 1 :]))
        places = [k // 3 for k in places]
        leaves = [digest(*leaves[k : k + 3]) for k in range(0, len(leaves), 3)]
    return leaves[0], paths


def brute_force(rows: list[dict]) -> list[tuple]:
    first = lambda x: (x is not None, x or 0)
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    grown = {}
    for source in sources:
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: (first(r["doc_id"]), leaf_of(r)))
        grown[source] = own, *tree([leaf_of(r) for r in own])
    root, above = tree([grown[s][1] for s in sources])
    out = []
    for source, top in zip(sources, above):
        own, subroot, paths = grown[source]
        for row, path in zip(own, paths):
            steps, found = path + top, dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                found["text"] = row["text"] and row["text"].replace("\n", "")
            folded = leaf_of(found)
            for before, after in steps:
                folded = digest(*before, folded, *after)
            siblings = digest(*[s for before, after in steps for s in before + after])
            out.append((row["doc_id"], leaf_of(row), subroot, root, siblings, folded, folded == root))
    return sorted(out, key=repr)


def check(df):
    got = sorted((tuple(r) for r in merkle.verified_manifest(df).select(*COLUMNS).collect()), key=repr)
    assert got == brute_force(rows_of(df.select(*merkle.FIELDS)))
    return got


@pytest.mark.parametrize("sizes", [(1,), (2,), (3, 1), (4, 9, 10, 28), (82, 1, 1, 1, 1, 1, 1, 1, 1, 1, 3)])
def test_trees_of_any_size(spark, sizes):
    names = [None, "", "b", "B", "é", "bb", *"cdefghi"]
    rows = [(100 * s + k, f"line\n{k}", "en", names[s], k) for s, n in enumerate(sizes) for k in range(n)]
    assert len(check(spark.createDataFrame(rows, SCHEMA))) == sum(sizes)


def test_edge_rows_and_nulls_in_every_column(corpus, spark):
    check(corpus(EDGES, clashing=True))
    row = (7, "a\nb", "en", "s", 3)
    rows = [tuple(None if k == hole else x for k, x in enumerate(row)) for hole in range(5)] + [row] * 4
    check(spark.createDataFrame([*rows, (8, LONG, "en", "s", len(LONG)), (None,) * 5], SCHEMA))
    assert merkle.verified_manifest(corpus([])).collect() == []


def test_tampering_shows_where_a_line_break_went(corpus):
    got = check(corpus([(k, "one\ntwo" if k % 3 else "one two") for k in range(40)]))
    broken = {r[0] for r in got if not r[-1]}
    assert broken == {k for k in range(40) if k % 3 and zlib.crc32(str(k).encode()) % 2 == 0}


def test_a_proof_stands_for_its_own_row_only(corpus):
    rows = merkle.manifest(corpus([(k, f"text {k}") for k in range(30)]))
    others = rows.select("doc_id", "proof").join(rows.select(F.col("doc_id").alias("other"), "leaf", "root"), F.expr("doc_id <> other"))
    assert others.filter(merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).count() == 0


def test_one_source_in_many_parts(spark):
    """Most rows in one source: its numbering is put together from parts."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(k % 90, f"t{k % 7}", "en", "hot" if k % 10 else f"s{k}", 2) for k in range(300)]
        check(spark.createDataFrame(rows, SCHEMA).repartition(6))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
