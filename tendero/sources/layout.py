"""Storage layout for repeated item-grain work.

Transactions and their lines are bucketed on ``transaction_id`` into the same number of buckets,
each bucket sorted, so the join every item-grain mart starts with reads both sides in place and
needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tendero.schemas import TABLE_NAMES, Tables

BUCKETED = {"transactions": "transaction_id", "transaction_items": "transaction_id"}
LEAST_BUCKETS, BUCKET_ROWS = 8, 1_000_000  # a task that joins a bucket holds about 200 MB


def buckets_for(tables: Tables, rows: int = BUCKET_ROWS) -> int:
    """Buckets of about ``rows`` rows of both facts together, so a task's share does not grow with the tables."""
    counted = sum(tables[name].count() for name in BUCKETED)
    return max(LEAST_BUCKETS, -(-counted // rows))


def store_retail(tables: Tables, prefix: str, buckets: int | None = None) -> None:
    """Save the base tables as ``<prefix>_<table>``, by default in as many buckets as their rows need
    (``buckets_for``).  Adaptive execution cannot split a bucket, so use it for
    tickets of ordinary size (``dq_hot_tickets`` finds the others)."""
    buckets = buckets_for(tables) if buckets is None else buckets
    for name in TABLE_NAMES:
        frame: DataFrame = tables[name]
        if name in BUCKETED:
            key = BUCKETED[name]
            # One task per bucket writes one file per bucket.
            writer = frame.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        else:
            writer = frame.write
        writer.format("parquet").mode("overwrite").saveAsTable(f"{prefix}_{name}")


def stored_retail(spark: SparkSession, prefix: str) -> Tables:
    return {name: spark.table(f"{prefix}_{name}") for name in TABLE_NAMES}
