"""The corpus pipeline: from raw documents to packed training sequences.

Each stage reads what the one before it has written.  The first four give the columns of
``documents``; the last one gives a row for each packed piece."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tendero.llm import decontam, neardup, packing, rules, secrets
from tendero.llm.common import materialise, table
from tendero.llm.registry import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a fixed rule or a certified cutoff go."""
    return rules.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return neardup.representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts become a mark."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens and their places in the packed sequences."""
    return packing.best_fit_packing(docs, vocabulary("word_bpe_49k.json"), length=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

# Rank statistics, sketches, alignments and tokenizers have no SQL form: tests/llm compares each
# stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, start=1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialise(docs, f"pipeline-{number}")
    return docs
