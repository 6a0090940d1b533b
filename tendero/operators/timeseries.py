"""Weekly series by format."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tendero.functions import net_amount, ratio, week_start
from tendero.operators.base import DateLike, horizon_or_last, union_all
from tendero.schemas import Tables


def last_complete_day(horizon):
    """The newest Sunday on or before the horizon: weeks run Monday to Sunday."""
    return F.date_sub(horizon, (F.weekday(horizon) + 1) % 7)


def weekly_sales(tables: Tables, horizon: DateLike | None = None) -> DataFrame:
    """Net sales by week and format; a last week the horizon cuts short is left out."""
    cutoff = last_complete_day(horizon_or_last(tables, horizon))
    per_store = (
        tables["transactions"]
        .filter(F.col("transaction_date") <= cutoff)
        .groupBy(week_start("transaction_date").alias("week_start"), "store_id")
        .agg(F.sum(net_amount()).alias("net"))
    )
    return (
        per_store.join(tables["stores"].select("store_id", "format"), "store_id")
        .groupBy("week_start", "format")
        .agg(F.sum("net").alias("net_gmv"))
    )


def weekly_change(weekly: DataFrame) -> DataFrame:
    """Change against the format's previous week with sales; NULL for its first week."""
    before = F.lag("net_gmv").over(Window.partitionBy("format").orderBy("week_start"))
    return weekly.withColumn("before", before).select(
        "week_start", "format", "net_gmv",
        (F.col("net_gmv") - F.col("before")).alias("wow_abs"),
        (ratio("net_gmv", "before") - 1).alias("wow_pct"),
    )


def format_volatility(weekly: DataFrame) -> DataFrame:
    value = F.col("net_gmv").cast("double")
    return (
        weekly.groupBy("format")
        .agg(ratio(F.sum("net_gmv"), F.count("net_gmv")).alias("mean"), F.stddev_samp(value).alias("std"))
        .withColumn("cv", ratio("std", "mean"))
    )


def weekly_extremes(changes: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` largest rises and the ``n`` largest drops."""
    tie = ("week_start", "format")
    rises = changes.orderBy(F.col("wow_abs").desc_nulls_last(), *tie).limit(n).withColumn("tipo", F.lit("SUBIDA"))
    drops = changes.orderBy(F.col("wow_abs").asc_nulls_last(), *tie).limit(n).withColumn("tipo", F.lit("CAIDA"))
    return union_all([rises, drops])
