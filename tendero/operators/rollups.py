"""The store-day mart as a stored table that wider reports read instead of the tickets.

It is partitioned by month, so a report of a period opens the months of the period only.  Beside the exact
counts of each store and day it keeps distinct-count sketches of the tickets and customers: sketches merge, exact
distinct counts do not, so weeks, countries or formats come from the mart without an id being moved again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendero.functions import net_amount, transaction_count, week_start
from tendero.operators.base import DateLike, as_date
from tendero.schemas import Tables
from tendero.sources.sinks import save

#: Registers of a sketch as a power of two.  The relative standard error is 1.04 / sqrt(2 ** LOG_K), 0.8 %.
LOG_K = 14
SKETCHED = ("tickets", "customers")


def _month(date: str | Column) -> Column:
    column = F.col(date) if isinstance(date, str) else date
    return (F.year(column) * 100 + F.month(column)).cast("int")


def store_day_mart(tables: Tables, unique_ids: bool = False) -> DataFrame:
    """``store_day`` with its month and the sketches of its tickets and customers."""
    daily = tables["transactions"].groupBy("transaction_date", "store_id").agg(
        F.sum(net_amount()).alias("gmv"), transaction_count(unique_ids).alias("tx"),
        F.hll_sketch_agg("transaction_id", LOG_K).alias("tickets_sketch"),
        F.hll_sketch_agg("customer_id", LOG_K).alias("customers_sketch"),
    )
    stores = tables["stores"].select("store_id", "store_name", "country", "format", "region", "size_sqm")
    return daily.join(stores, "store_id").select(
        F.col("transaction_date").alias("date"), "store_id", "store_name", "country", "format", "region", "size_sqm",
        "gmv", "tx", "tickets_sketch", "customers_sketch", _month("transaction_date").alias("month"),
    )


def save_store_day(tables: Tables, path: str, unique_ids: bool = False) -> DataFrame:
    return save(store_day_mart(tables, unique_ids), path=path, partition_by=("month",))


def read_store_day(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def store_day_between(mart: DataFrame, start: DateLike, end: DateLike, **selectors: object) -> DataFrame:
    """Rows of the mart in a period, of the stores that the selectors (country, format, ...) name.  Only the
    months of the period are opened."""
    first, last = as_date(start), as_date(end)
    rows = mart.filter(F.col("month").between(_month(first), _month(last))).filter(F.col("date").between(first, last))
    for name, value in selectors.items():
        if value is not None:
            rows = rows.filter(F.col(name) == F.lit(value))
    return rows


def store_day_on(mart: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows of the mart on the days of ``dates`` (column ``fecha``), a selection from ``dim_date``.  Which months
    these are is known when the query runs: the scan is pruned by the join."""
    chosen = dates.select(F.col("fecha").alias("date"), _month("fecha").alias("month"))
    return mart.join(chosen, ["month", "date"], "left_semi")


def distinct_rollup(mart: DataFrame, *keys: str) -> DataFrame:
    """Distinct tickets and customers by ``keys`` (columns of the mart, or ``week_start``), estimated from the
    sketches of the days: each group moves sketches of bounded size, never ids."""
    rows = mart.withColumn("week_start", week_start("date")) if "week_start" in keys else mart
    merged = rows.groupBy(*keys).agg(
        *[F.hll_union_agg(f"{name}_sketch").alias(name) for name in SKETCHED], F.sum("gmv").alias("gmv")
    )
    return merged.select(*keys, "gmv", *[F.hll_sketch_estimate(name).alias(f"{name}_estimate") for name in SKETCHED])
