"""Freshness of the live feed: each closed hour of each store against a stored profile of its weekday and hour.

The profile is a table, made again once a week from the weeks before.  The stream gives hours as they close;
each hour meets the profile's rows of its slot, of which there is one for each store, so a store that is silent in it
is seen as well."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tendero.functions import ratio
from tendero.operators.incremental import hourly_tickets
from tendero.streaming.feed import hourly_sales

WEEK_HOURS = 168
BATCH = "hours_to"


def _slot(hour: Column) -> list[Column]:
    return [F.weekday(hour).alias("slot_day"), F.hour(hour).alias("slot_hour")]


def slot_profile(feed: DataFrame, until: Column, weeks: int = 3, stores: DataFrame | None = None) -> DataFrame:
    """(store_id, slot_day, slot_hour, expected, reported): what the week after ``until`` is expected to bring, the
    mean of the same weekday and hour in the ``weeks`` before, from the store's first hour on.  Hours without
    tickets count as zero.  With ``stores`` (the active ones), one that never reported is in it as such."""
    past = hourly_tickets(feed.filter(F.col("ts") < until)).select("store_id", "hour", "tickets")
    begun = past.groupBy("store_id").agg(F.min("hour").alias("first"))
    if stores is not None:
        begun = stores.select("store_id").distinct().join(begun, "store_id", "left")
    start = F.date_trunc("hour", until)
    hours = F.sequence(start, start + F.make_dt_interval(hours=F.lit(WEEK_HOURS - 1)), F.expr("interval 1 hour"))
    earlier = F.explode(F.sequence(F.lit(1), F.lit(weeks))).alias("back")
    slots = begun.select("store_id", "first", F.explode(hours).alias("ahead")).select("*", earlier)
    wanted = slots.withColumn("hour", F.col("ahead") - F.make_dt_interval(days=F.col("back") * 7))
    seen = wanted.join(past, ["store_id", "hour"], "left")
    counts = F.when(F.col("hour") >= F.col("first"), F.coalesce("tickets", F.lit(0)))
    return seen.groupBy("store_id", *_slot(F.col("ahead"))).agg(
        ratio(F.sum(counts), F.count(counts)).alias("expected"), F.bool_or(F.col("first").isNotNull()).alias("reported")
    )


def judged_hours(closed: DataFrame, hours: DataFrame, profile: DataFrame, floor: float = 0.5) -> DataFrame:
    """(store_id, hour, tickets, expected, late) of ``hours`` (column hour), for every store of the profile, from
    the totals in ``closed`` (window_start, store_id, tickets).  Late is an hour under ``floor`` of its
    expectation, and any of a store that never reported."""
    slots = hours.select("hour", *_slot(F.col("hour")))
    sold = closed.select("store_id", F.col("window_start").alias("hour"), "tickets")
    met = slots.join(profile, ["slot_day", "slot_hour"]).join(sold, ["store_id", "hour"], "left")
    tickets = F.coalesce("tickets", F.lit(0).cast("long"))
    short = ~F.col("reported") | F.coalesce(tickets < F.col("expected") * floor, F.lit(False))
    return met.select("store_id", "hour", tickets.alias("tickets"), "expected", short.alias("late"))


def _judged_until(spark: SparkSession, path: str, before: int) -> int | None:
    """The last hour (in seconds) of the batches that end before an hour."""
    try:
        batches = spark.read.schema(f"{BATCH} long").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return batches.filter(F.col(BATCH) < before).agg(F.max(BATCH)).first()[0]


def watch_freshness(
    feed: DataFrame, profile: DataFrame, path: str, checkpoint: str, floor: float = 0.5, delay: str = "2 hours"
) -> None:
    """Drain the feed into the table of judged hours below ``path``.  An hour closes for all stores in the same
    batch, and a batch judges every hour up to its last one, also those in which no store sent anything.  It
    writes a folder that its last hour names, so a replay replaces what it wrote before."""

    def judge(closed: DataFrame, _: int) -> None:
        spark = closed.sparkSession
        first, last = closed.agg(F.min(F.unix_seconds("window_start")), F.max(F.unix_seconds("window_start"))).first()
        if last is None:
            return
        judged = _judged_until(spark, path, last)
        start = F.timestamp_seconds(F.lit(first if judged is None else judged + 3600))
        hours = spark.range(1).select(
            F.explode(F.sequence(start, F.timestamp_seconds(F.lit(last)), F.expr("interval 1 hour"))).alias("hour")
        )
        judged_hours(closed, hours, profile, floor).write.mode("overwrite").parquet(f"{path}/{BATCH}={last}")

    (
        hourly_sales(feed, delay)
        .writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
