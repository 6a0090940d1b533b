"""Incremental loads in batch form: latest version per key, upsert, certification, freshness and
reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tendero.functions import line_amount, net_amount, ratio, row_hash, signed
from tendero.operators.base import DateLike, as_date, horizon_or_last
from tendero.schemas import Tables
from tendero.session import work_folder
from tendero.sources import versions


def latest_per_key(rows: DataFrame, keys: tuple[str, ...], version: str) -> DataFrame:
    """The newest row of each key.  ``max_by`` combines on the map side, so a key with very many
    copies is reduced before it moves; equal versions are settled by row content."""
    values = [c for c in rows.columns if c not in keys]
    order = F.struct(F.col(version), row_hash(rows.columns))
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("row"))
    return newest.select(*keys, "row.*").select(*rows.columns)


def _one_per_key(updates: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The updates' values as one struct per key.  A doubled or NULL key stops the job."""
    values = [c for c in updates.columns if c not in keys]
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    grouped = updates.groupBy(*keys).agg(F.any_value(F.struct(*values)).alias("new"), F.count("*").alias("copies"))
    new = (
        F.when(missing, F.raise_error(F.lit("an update has a NULL key")))
        .when(F.col("copies") > 1, F.raise_error(F.lit("an update holds a key more than once; give a version")))
        .otherwise(F.col("new"))
    )
    return grouped.select(*keys, new.alias("new"))


def merge_upsert(
    target: DataFrame, updates: DataFrame, keys: tuple[str, ...], version: str | None = None
) -> DataFrame:
    """Target rows with the updates applied: new keys are added, and a known key is replaced only
    when its content changed.  ``merge_action`` says which happened.

    ``version`` is a column of both sides: of several updates of a key the newest counts, and it
    replaces the stored row only if it is newer than that.  Without it the updates must hold each
    key once.  Keys may not be NULL."""
    columns = target.columns
    values = [c for c in columns if c not in keys]
    updates = updates.select(*columns)
    if version is not None:
        if version not in values:
            raise ValueError(f"the target must store the version, {version}")
        updates = latest_per_key(updates, keys, version)
    old = target.select(*keys, F.struct(*values).alias("old"))
    differs = ~F.col("new").eqNullSafe(F.col("old"))
    if version is not None:
        differs = differs & F.coalesce(F.col(f"new.{version}") > F.col(f"old.{version}"), F.col(f"old.{version}").isNull())
    action = (
        F.when(F.col("new").isNull(), "kept")
        .when(F.col("old").isNull(), "inserted")
        .when(differs, "updated")
        .otherwise("unchanged")
    )
    merged = old.join(_one_per_key(updates, keys), list(keys), "full_outer").withColumn("merge_action", action)
    taken = F.when(F.col("merge_action").isin("inserted", "updated"), F.col("new")).otherwise(F.col("old"))
    return merged.withColumn("row", taken).select(*keys, "row.*", "merge_action").select(*columns, "merge_action")


def upsert_partitions(
    spark: SparkSession, path: str, updates: DataFrame, keys: tuple[str, ...], partition: str,
    version: str | None = None,
) -> None:
    """Apply updates to a Parquet table partitioned by ``partition``, reading and rewriting only the
    partitions that receive rows.  The partition must be one of ``keys``: a row that changes it is
    another row.  (Use ``merge_upsert`` and a full rewrite where keys may move.)

    The new partitions are written whole to shared storage first.  The table is never read while it
    is overwritten, and an overwrite that is cut off can be repeated from there or by a replay."""
    if partition not in keys:
        raise ValueError(f"{partition} must be one of the keys; rewrite the table with merge_upsert where keys move")
    columns = spark.read.parquet(path).columns
    updates = updates.select(*columns)
    # Given types: a partition called 01 stays text.
    target = spark.read.schema(updates.schema).parquet(path)
    touched = [r[0] for r in updates.select(partition).distinct().collect()]  # folders of the table
    if not touched:
        return
    known = [F.lit(x).cast(updates.schema[partition].dataType) for x in touched if x is not None]
    own = F.col(partition).isin(*known) if known else F.lit(False)
    if None in touched:
        own = own | F.col(partition).isNull()
    affected = target.filter(own)
    if None in touched:
        # NULL is a partition as well: under a key of its own it takes part in the join.
        merged = _merge_with_null_partition(affected, updates, keys, partition, version)
    else:
        merged = merge_upsert(affected, updates, keys, version).drop("merge_action")
    staged = work_folder(spark, "upsert-staged")
    merged.write.parquet(staged)
    # Rebalancing lets AQE split a partition that holds most rows and join the small ones.
    (
        spark.read.schema(merged.schema).parquet(staged)
        .hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def _merge_with_null_partition(
    target: DataFrame, updates: DataFrame, keys: tuple[str, ...], partition: str, version: str | None
) -> DataFrame:
    rest = tuple(k for k in keys if k != partition)
    found = merge_upsert(
        target.filter(F.col(partition).isNotNull()), updates.filter(F.col(partition).isNotNull()), keys, version
    )
    nameless = merge_upsert(
        target.filter(F.col(partition).isNull()), updates.filter(F.col(partition).isNull()), rest, version
    )
    return found.unionByName(nameless).drop("merge_action")


# ---------------------------------------------------------------- certification and freshness
def day_certification(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    """Per day: stores expected (open by then), stores that reported, and whether the day may be
    certified.  A store missing for the whole day blocks it."""
    first, last = as_date(start), as_date(end)
    opened = F.greatest(first, F.col("opening_date"))
    expected = (
        tables["stores"]
        .filter(F.col("opening_date") <= last)
        .select("store_id", F.explode(F.sequence(opened, last)).alias("date"))
    )
    reported = (
        tables["transactions"]
        .filter(F.col("transaction_date").between(first, last))
        .groupBy("store_id", F.col("transaction_date").alias("date"))
        .agg(F.count("*").alias("tickets"))
    )
    return (
        expected.join(reported, ["store_id", "date"], "left")
        .groupBy("date")
        .agg(
            F.count("*").alias("stores_expected"),
            F.count("tickets").alias("stores_reported"),
            F.count_if(F.col("tickets").isNull()).alias("stores_missing"),
        )
        .withColumn("certified", F.col("stores_missing") == 0)
    )


def missing_store_days(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    """The (store, day) pairs that block certification."""
    first, last = as_date(start), as_date(end)
    expected = (
        tables["stores"]
        .filter(F.col("opening_date") <= last)
        .select("store_id", F.explode(F.sequence(F.greatest(first, F.col("opening_date")), last)).alias("date"))
    )
    reported = tables["transactions"].filter(F.col("transaction_date").between(first, last)).select(
        "store_id", F.col("transaction_date").alias("date")
    )
    return expected.join(reported, ["store_id", "date"], "left_anti")


def hourly_tickets(feed: DataFrame) -> DataFrame:
    return feed.groupBy("store_id", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count("*").alias("tickets"), F.sum(net_amount()).alias("ventas_netas")
    )


def freshness_expected(
    feed: DataFrame, weeks: int = 3, floor: float = 0.5, stores: DataFrame | None = None
) -> DataFrame:
    """Each store hour against the mean of the same weekday and hour in the preceding weeks.
    Silent hours count as zero; an hour is late when it holds under ``floor`` of its expectation.
    With ``stores`` (the active ones), a store that never reported has hours from the feed's first one
    on, all of them late."""
    hourly = hourly_tickets(feed).select("store_id", "hour", "tickets")
    last = feed.agg(F.max(F.date_trunc("hour", "ts"))).scalar()
    begun = hourly.groupBy("store_id").agg(F.min("hour").alias("first"))
    if stores is not None:
        first = feed.agg(F.min(F.date_trunc("hour", "ts"))).scalar()
        absent = stores.select("store_id").distinct().join(begun, "store_id", "left_anti")
        begun = begun.withColumn("reported", F.lit(True)).unionByName(
            absent.select("store_id", first.alias("first"), F.lit(False).alias("reported"))
        )
    else:
        begun = begun.withColumn("reported", F.lit(True))
    spine = begun.select(
        "reported",
        "store_id", F.explode(F.sequence("first", last, F.expr("interval 1 hour"))).alias("hour")
    )
    dense = spine.join(hourly, ["store_id", "hour"], "left").withColumn("tickets", F.coalesce("tickets", F.lit(0)))
    same_slot = Window.partitionBy("store_id", F.weekday("hour"), F.hour("hour")).orderBy("hour").rowsBetween(-weeks, -1)
    expected = ratio(F.sum("tickets").over(same_slot), F.count("tickets").over(same_slot))
    late = ~F.col("reported") | F.coalesce(F.col("tickets") < F.col("expected") * floor, F.lit(False))
    return dense.withColumn("expected", expected).withColumn("late", late).drop("reported")


def alert_time(last: Column, hours: int = 2, opening: int = 8, closing: int = 22) -> Column:
    """When a store that was last heard of at ``last`` has been silent for ``hours`` of opening time:
    that many hours later, but on a day not before the hours have passed since opening, and where
    this falls after closing, on the next day.  Rises with ``last``."""
    due = last + F.make_dt_interval(hours=F.lit(hours))
    day = F.date_trunc("day", due)
    earliest = day + F.make_dt_interval(hours=F.lit(opening + hours))
    tomorrow = earliest + F.make_dt_interval(days=F.lit(1))
    return F.when(F.hour(due) >= closing, tomorrow).otherwise(F.greatest(due, earliest))


def silent_intervals(
    feed: DataFrame, hours: int = 2, opening: int = 8, closing: int = 22, stores: DataFrame | None = None
) -> DataFrame:
    """Store silences of at least ``hours`` of opening time: last ticket seen, moment of the alert,
    and the ticket that ended it (NULL while the store is still silent, which only counts once the
    feed itself has moved past the alert).  With ``stores`` (the active ones), a store that never
    reported is silent from the start of the feed; its last ticket is NULL."""
    if hours < 1:
        raise ValueError("hours must be at least 1")
    now = feed.agg(F.max("ts")).scalar()
    # A silence of an hour or more always runs from the last ticket of one clock hour to the first
    # of a later one, so (store, hour) extremes are enough and bound the window by time, not load.
    extremes = feed.groupBy("store_id", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    following = F.lead("first_ts").over(Window.partitionBy("store_id").orderBy("hour"))
    seen = extremes.select("store_id", "last_ts", following.alias("next_ts"), F.col("last_ts").alias("since"))
    if stores is not None:
        began = feed.agg(F.min("ts")).scalar()
        absent = stores.select("store_id").distinct().join(extremes.select("store_id").distinct(), "store_id", "left_anti")
        none = F.lit(None).cast("timestamp")
        seen = seen.unionByName(absent.select("store_id", none.alias("last_ts"), none.alias("next_ts"), began.alias("since")))
    return (
        seen.withColumn("alert_at", alert_time(F.col("since"), hours, opening, closing))
        .filter(F.coalesce("next_ts", now) >= F.col("alert_at"))
        .select("store_id", "last_ts", "alert_at", "next_ts")
    )


def reprocess_window(feed: DataFrame, until: Column, hours: int = 3) -> DataFrame:
    """Recompute the hourly totals of the last ``hours`` whole hours before ``until``; the frame
    replaces exactly those hours in the stored table."""
    end = F.date_trunc("hour", until)
    start = end - F.make_dt_interval(hours=F.lit(hours))
    return hourly_tickets(feed.filter((F.col("ts") >= start) & (F.col("ts") < end)))


def rolling_sales(feed: DataFrame, width: str = "3 hours", step: str = "1 hour") -> DataFrame:
    """Rolling totals per store over sliding windows.  Hours are summed once and each hour total,
    not each ticket, is copied into the windows that cover it."""
    hourly = hourly_tickets(feed)
    return hourly.groupBy("store_id", F.window("hour", width, step)).agg(
        F.sum("tickets").alias("tickets"), F.sum("ventas_netas").alias("ventas_netas")
    ).select("store_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
             "tickets", "ventas_netas")


def close_day(tables: Tables, day: DateLike | None = None) -> DataFrame:
    """Daily close: store totals of one day recomputed in full (by default the day before the
    newest one)."""
    closing = F.date_sub(horizon_or_last(tables, None), 1) if day is None else as_date(day)
    return (
        tables["transactions"]
        .filter(F.col("transaction_date") == closing)
        .groupBy("store_id", "transaction_date")
        .agg(F.sum(net_amount()).alias("ventas_netas"), F.count("*").alias("transacciones"))
    )


def reconcile_metric(tables: Tables) -> DataFrame:
    """Net sales by store and status at ticket grain against item grain, and the difference."""
    tickets = tables["transactions"].groupBy("store_id", "status").agg(
        F.sum(net_amount()).alias("ventas_tickets"), F.count("*").alias("tickets")
    )
    lines = tables["transaction_items"].groupBy("transaction_id").agg(F.sum(line_amount()).alias("line"))
    items = (
        lines.join(tables["transactions"].select("transaction_id", "store_id", "status"), "transaction_id")
        .groupBy("store_id", "status")
        .agg(F.sum(signed(F.col("line"))).alias("ventas_items"), F.count("*").alias("tickets_con_items"))
    )
    both = tickets.join(items, ["store_id", "status"], "full_outer")
    zero = F.lit(0).cast("decimal(18,2)")
    return both.select(
        "store_id", "status",
        F.coalesce("ventas_tickets", zero).alias("ventas_tickets"),
        F.coalesce("ventas_items", zero).alias("ventas_items"),
        (F.coalesce("ventas_tickets", zero) - F.coalesce("ventas_items", zero)).alias("diferencia"),
        F.coalesce("tickets", F.lit(0)).alias("tickets"),
        F.coalesce("tickets_con_items", F.lit(0)).alias("tickets_con_items"),
    )


# ---------------------------------------------------------------- stored days
def store_hours(feed: DataFrame, path: str) -> int:
    """The hourly totals of a feed as a stored table, a part for each day."""
    hours = hourly_tickets(feed).withColumn("date", F.to_date("hour"))
    return versions.replace_parts(hours, path, "date", hours.select("date").distinct())


def reprocess_hours(feed: DataFrame, path: str, until: Column, hours: int = 3) -> int:
    """Put the recomputed totals of ``reprocess_window`` back into the stored table: exactly those hours are
    replaced, hours that are empty now are gone, and the days they belong to change all at once."""
    spark = feed.sparkSession
    end = F.date_trunc("hour", until)
    window = spark.range(1).select((end - F.make_dt_interval(hours=F.lit(hours))).alias("start"), end.alias("end"))
    # Two moments; as numbers they do not depend on a time zone.
    start_at, end_at = window.select(F.unix_micros("start"), F.unix_micros("end")).first()
    start, end = F.timestamp_micros(F.lit(start_at)), F.timestamp_micros(F.lit(end_at))
    last = F.timestamp_micros(F.lit(end_at - 1))
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(start), F.to_date(last))).alias("date"))
    fresh = reprocess_window(feed, end, hours).withColumn("date", F.to_date("hour"))
    touched = [str(r.date) for r in days.collect()]
    kept = versions.read_parts(spark, path, fresh.schema, parts=touched).filter((F.col("hour") < start) | (F.col("hour") >= end))
    return versions.replace_parts(kept.unionByName(fresh), path, "date", days)


def publish_certified(mart: DataFrame, certification: DataFrame, path: str) -> int:
    """Expose the days of a mart (column ``date``) that are certified.  A blocked day keeps what was published
    for it before, if anything; a certified day without rows is published as empty."""
    return versions.replace_parts(mart, path, "date", certification.filter("certified").select("date"))
