"""The hourly ticket feed as Structured Streaming jobs.

A feed has ``transaction_id, ts, store_id, total_amount, status``.  Each job is a transformation
of a streaming DataFrame; ``run_available`` drains what has arrived into a Parquet table whose
checkpoint lives beside it on shared storage, so a lost executor or driver resumes exactly once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendero.functions import net_amount, ratio, row_hash
from tendero.operators.incremental import alert_time, upsert_partitions

VALID = "ok"


def run_available(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    output_mode: str = "append",
) -> None:
    """Process everything available, including the final watermark, then stop."""
    writer = stream.writeStream.format("parquet").outputMode(output_mode).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("path", path).trigger(availableNow=True).start().awaitTermination()


def ingest(raw: DataFrame) -> DataFrame:
    """Raw rows with where they came from: source file, a digest of their content, and the arrival
    date to partition by.  ``raw`` must be a file stream, which carries ``_metadata``.  A file's
    fingerprint is ``file_fingerprints`` of its rows, whatever it is called."""
    return raw.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        row_hash(raw.columns).alias("row_hash"),
        F.to_date(F.col("_metadata.file_modification_time")).alias("arrival_date"),
    )


def file_fingerprints(ingested: DataFrame) -> DataFrame:
    """By file: its rows, and a digest of their content that depends neither on their order nor on
    the file's name, so a file that is sent again is recognised."""
    parts = [F.conv(F.substring("row_hash", at, 8), 16, 10).cast("decimal(38,0)") for at in (1, 9, 17, 25)]
    sums = [F.sum(p).cast("string") for p in parts]
    counted = F.count("*")
    return ingested.groupBy("source_file").agg(
        counted.alias("rows"), F.sha2(F.concat_ws("|", counted.cast("string"), *sums), 256).alias("source_hash")
    )


LEDGER = "source_hash string, source_file string, rows long, load string"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The files that ``ingest_once`` has stored below ``path``, a row for each content."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{path}/ledger")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


@contextmanager
def _unsorted_partitions(spark: SparkSession) -> Iterator[None]:
    """Rows are written to partitions as they come, not sorted by partition first: all rows of a file have one
    arrival date.  Beyond this number of open files a task sorts the rest."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "8")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def load_batch(batch: DataFrame, path: str) -> None:
    """Store the rows of the files of a batch (as ``ingest`` gives them, whole files) whose content is new.

    A load is named by the contents it brings, its rows are written first, and the ledger's file is added last.
    What is cut off before that is not read by anybody, and the next try, in whatever batch the files
    come, either replaces it or leaves it unread.  A batch that comes again finds its files in the ledger."""
    spark = batch.sparkSession
    known = ledger(spark, path)
    fresh = (
        file_fingerprints(batch)
        .join(known, "source_hash", "left_anti")
        .groupBy("source_hash")
        .agg(F.min("source_file").alias("source_file"), F.first("rows").alias("rows"))
        .collect()  # a row for each file of the batch, which the driver has listed
    )
    if not fresh:
        return
    load = hashlib.sha256("".join(sorted(r.source_hash for r in fresh)).encode()).hexdigest()[:32]
    files = spark.createDataFrame([(r.source_hash, r.source_file, r.rows, load) for r in fresh], LEDGER)
    # The list is the driver's own, so it goes to the rows: by file, a file's rows would meet in one task.
    rows = batch.join(F.broadcast(files.select("source_file", "source_hash")), "source_file")
    with _unsorted_partitions(spark):
        rows.write.mode("overwrite").partitionBy("arrival_date").parquet(f"{path}/rows/load={load}")
    files.coalesce(1).write.mode("append").parquet(f"{path}/ledger")


def ingest_once(raw: DataFrame, path: str, checkpoint: str) -> None:
    """Drain a file stream into the table below ``path``.  A file that was stored before adds nothing, under
    whatever name and in whatever order of rows it is sent again, also with a new checkpoint."""
    (
        ingest(raw)
        .writeStream.foreachBatch(lambda batch, _: load_batch(batch, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def ingested(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored rows: ``schema`` is that of the raw rows; ``source_file``, ``source_hash``, ``row_hash``
    and ``arrival_date`` are added.  Only loads that the ledger names are read."""
    added = [T.StructField(c, T.StringType()) for c in ("source_file", "row_hash", "source_hash", "load")]
    whole = T.StructType([*schema, *added, T.StructField("arrival_date", T.DateType())])
    loads = ledger(spark, path).select("load").distinct()
    return spark.read.schema(whole).parquet(f"{path}/rows").join(loads, "load", "left_semi").drop("load")


def verdict(min_amount: float = 0.0) -> Column:
    """The first check a row fails, or ``ok``."""
    return (
        F.when(F.col("transaction_id").isNull(), "missing_key")
        .when(F.col("ts").isNull(), "missing_time")
        .when(F.col("store_id").isNull(), "missing_store")
        .when(F.col("total_amount").isNull(), "missing_amount")
        .when(F.col("total_amount") <= min_amount, "nonpositive_amount")
        .otherwise(VALID)
    )


def validate(feed: DataFrame, min_amount: float = 0.0) -> DataFrame:
    """Rows with their verdict.  Written with ``partition_by=("verdict",)``, good and bad rows are
    separate partitions of one exactly-once table, from one pass over the batch."""
    return feed.withColumn("verdict", verdict(min_amount))


def rejection_findings(checked: DataFrame) -> DataFrame:
    """Rejected rows of a validated table as audit findings, one row per failed check."""
    counts = checked.groupBy("verdict").agg(F.count("*").alias("failed"))
    total = counts.agg(F.sum("failed")).scalar()
    return counts.filter(F.col("verdict") != VALID).select(
        F.lit("Staging").alias("dimension"), F.col("verdict").alias("check"), "failed", total.alias("total"),
        (ratio("failed", total) * 100).alias("pct"),
    )


def dedup_feed(feed: DataFrame, keys: tuple[str, ...] = ("transaction_id",), delay: str = "2 hours") -> DataFrame:
    """One row per key among rows less than ``delay`` apart."""
    return feed.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def hourly_sales(feed: DataFrame, delay: str = "2 hours", width: str = "1 hour") -> DataFrame:
    """Closed hourly totals per store.  A ticket up to ``delay`` late still lands in its hour."""
    return (
        feed.withWatermark("ts", delay)
        .groupBy(F.window("ts", width), "store_id")
        .agg(F.count("*").alias("tickets"), F.sum(net_amount()).alias("ventas_netas"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            "store_id", "tickets", "ventas_netas",
        )
    )


def rolling_sales_stream(
    feed: DataFrame, delay: str = "2 hours", width: str = "3 hours", step: str = "1 hour"
) -> DataFrame:
    """Closed rolling totals per store over sliding windows."""
    return (
        feed.withWatermark("ts", delay)
        .groupBy(F.window("ts", width, step), "store_id")
        .agg(F.count("*").alias("tickets"), F.sum(net_amount()).alias("ventas_netas"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            "store_id", "tickets", "ventas_netas",
        )
    )


def no_data_alerts(
    feed: DataFrame, silence_hours: int = 2, delay: str = "2 hours", opening: int = 8, closing: int = 22
) -> DataFrame:
    """Stores that were silent for ``silence_hours`` of opening time.  A ticket keeps its store's
    session open until the alert that it would lead to, over night as well, so a session that
    closes is an alert.  Stores that never sent a ticket are found by ``silent_intervals``."""
    due = alert_time(F.col("ts"), silence_hours, opening, closing)
    gap = due.cast("double") - F.col("ts").cast("double")
    return (
        feed.withColumn("gap", F.concat(F.ceil(gap * 1_000_000).cast("string"), F.lit(" microseconds")))
        .withWatermark("ts", delay)
        .groupBy(F.session_window("ts", F.col("gap")).alias("session"), "store_id")
        .agg(F.count("*").alias("tickets"), F.max("ts").alias("last_ts"))
        .select(
            "store_id", "tickets", "last_ts",
            alert_time(F.col("last_ts"), silence_hours, opening, closing).alias("alert_at"),
        )
    )


def upsert_stream(
    feed: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...], partition: str, version: str
) -> None:
    """Apply each micro-batch to a partitioned Parquet table that holds the version.  The upsert is
    idempotent and older versions never win: a batch that is replayed, or comes late, changes nothing."""

    def apply(batch: DataFrame, _: int) -> None:
        upsert_partitions(batch.sparkSession, path, batch, keys, partition, version)

    (
        feed.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
