from __future__ import annotations

import random

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline
from tendero.llm import decontam, registry, rules, secrets
from tests.llm.conftest import prose
from tests.llm.test_neardup import brute as near_brute


@pytest.fixture(scope="module")
def folder(spark, corpus, labels, tmp_path_factory):
    """A small corpus with a case for each stage, as Parquet tables."""
    rng = random.Random(8)
    path = tmp_path_factory.mktemp("corpus")
    items = [(k, prose(rng, 40)) for k in range(5)]
    rows = [(k, prose(rng, 60)) for k in range(40)]
    rows += [(100, rows[0][1]), (101, rows[1][1] + " more"), (102, f"x {items[2][1]} y"), (103, rows[2][1] + " password=abcdefgh1234")]
    rows += [(104, "too short"), (105, "again and " * 30), (106, None), (107, "")]
    rows[3] = (3, rows[3][1] + " token: zzzzzzzz99")
    corpus(rows).write.parquet(str(path / "documents.parquet"))
    labels([(k, 1, 0) for k in range(40)]).write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), rows, items


def test_stages_against_brute_force(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]
    kept = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = registry.materialise(stage(spark, docs, path), "test-stage")
        if number < 4:
            assert docs.columns == columns
            kept.append({r.doc_id: r.text for r in docs.collect()})

    def fine(text):
        c = dict(zip(rules.COUNTS, rules.counts_of(text or ""), strict=True))
        return c["n_words"] >= 10 and 100 * c["n_repeat_words"] <= 20 * c["n_words"]

    first = {d: t for d, t in rows if fine(t)}
    assert kept[0] == first
    own = near_brute(list(first.items()))
    assert kept[1] == {d: first[d] for d, _, least in own if d == least}
    held = lambda t: any(decontam.plain(x) in decontam.plain(t) for _, x in items)
    assert kept[2] == {d: t for d, t in kept[1].items() if not held(t)} and 102 not in kept[2]
    assert kept[3] == {d: secrets.redacted(t, secrets.spans(t)) for d, t in kept[2].items()}
    assert "[SECRET]" in kept[3][3] and set(r.doc_id for r in docs.collect()) == set(kept[3])


def test_run_gives_the_same_as_the_stages(spark, folder):
    path, rows, _ = folder
    found = corpus_pipeline.run(spark, path)
    assert found.where("piece = 0").count() == 40 and corpus_pipeline.ORACLE_SQL is None


def test_registry_has_one_query_for_each_operator():
    names = registry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(registry.oracle_sql()) <= set(names)
