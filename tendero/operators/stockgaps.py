"""Runs of days without a completed sale, and what they may have cost.

``stock_gaps`` never builds a calendar: the row count stays at (grain, sale day), bounded by the
days in the period whatever share of the lines one item holds.  ``stock_gaps_calendar`` is the
day-by-day formulation, kept as an independent cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tendero.functions import ratio
from tendero.operators.base import DateLike, completed_lines, horizon_or_last
from tendero.schemas import NO_VENDOR, Tables

STORE_ITEM = ("store_id", "item_id")
_TICKET_KEYS = ("store_id", "transaction_date")


def grain_lines(
    tables: Tables, grain: tuple[str, ...] = STORE_ITEM, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Completed lines with the grain's columns.  A grain may name store, item, category or vendor
    columns; the product join happens only when the grain needs it.  Date bounds apply to the
    tickets, so they prune their scan before the join."""
    lines = completed_lines(tables, _TICKET_KEYS)
    if start is not None:
        lines = lines.filter(F.col("transaction_date") >= start)
    if end is not None:
        lines = lines.filter(F.col("transaction_date") <= end)
    product_columns = [c for c in grain if c not in ("store_id", "item_id")]
    if product_columns:
        lines = lines.join(tables["products"].select("item_id", *product_columns), "item_id")
    return lines


def daily_item_sales(tables: Tables, grain: tuple[str, ...] = STORE_ITEM, end: Column | None = None) -> DataFrame:
    """Completed units and gross sales per grain and day."""
    return grain_lines(tables, grain, end=end).groupBy(*grain, F.col("transaction_date").alias("fecha_venta")).agg(
        F.sum("quantity").alias("unidades"), F.sum("line").alias("ventas_brutas")
    )


def date_spine(daily: DataFrame, horizon: Column, grain: tuple[str, ...] = STORE_ITEM) -> DataFrame:
    """Every day from the first sale of each grain to the horizon."""
    first = daily.groupBy(*grain).agg(F.min("fecha_venta").alias("first_day")).filter(F.col("first_day") <= horizon)
    return first.select(*grain, F.explode(F.sequence("first_day", horizon)).alias("fecha_calendario"))


def _named(gaps: DataFrame, tables: Tables, grain: tuple[str, ...]) -> DataFrame:
    """Attach the attributes the grain determines."""
    out = gaps
    columns = [*grain]
    if "store_id" in grain:
        out = out.join(tables["stores"].select("store_id", "store_name", "country", "format", "region"), "store_id")
        columns += ["store_name", "country", "format", "region"]
    if "item_id" in grain:
        owned = [c for c in ("item_name", "category", "vendor_id") if c not in grain]
        out = out.join(tables["products"].select("item_id", *owned), "item_id")
        columns += owned
    if "vendor_id" in columns:
        out = out.join(tables["vendors"].select("vendor_id", "vendor_name"), "vendor_id", "left")
        out = out.withColumn("vendor_name", F.coalesce("vendor_name", F.lit(NO_VENDOR)))
        columns.append("vendor_name")
    return out.select(
        *columns, "fecha_inicio_ausencia", "fecha_fin_ausencia", "dias_sin_venta",
        "venta_diaria_promedio_previa",
        (F.col("venta_diaria_promedio_previa") * F.col("dias_sin_venta")).alias("venta_estimada_perdida"),
        "active_gap",
    )


def gap_runs(
    daily: DataFrame, horizon: Column, grain: tuple[str, ...], min_days: int = 3, lookback: int = 14
) -> DataFrame:
    """Gaps between consecutive sale days, and from the last one to the horizon.

    The look-back before a gap ends on the last sale day, so it is a RANGE frame read on that row;
    it shares its partitioning and sort with the ``lead``."""
    ordered = Window.partitionBy(*grain).orderBy("day_number")
    previous_days = ordered.rangeBetween(-(lookback - 1), 0)
    sold = daily.withColumn("day_number", F.unix_date("fecha_venta"))
    next_sale = F.lead("fecha_venta").over(ordered)
    runs = sold.select(
        *grain,
        F.date_add("fecha_venta", 1).alias("fecha_inicio_ausencia"),
        next_sale.alias("next_sale"),
        F.sum("ventas_brutas").over(previous_days).alias("before"),
    )
    end = F.coalesce(F.date_sub("next_sale", 1), horizon)
    return (
        runs.withColumn("fecha_fin_ausencia", end)
        .withColumn(
            "dias_sin_venta", (F.datediff("fecha_fin_ausencia", "fecha_inicio_ausencia") + 1).cast("long")
        )
        .filter(F.col("dias_sin_venta") >= min_days)
        .withColumn("venta_diaria_promedio_previa", ratio("before", F.lit(lookback)))
        .withColumn("active_gap", F.col("next_sale").isNull())
        .drop("next_sale", "before")
    )


def stock_gaps(
    tables: Tables,
    grain: tuple[str, ...] = STORE_ITEM,
    horizon: DateLike | None = None,
    min_days: int = 3,
    lookback: int = 14,
) -> DataFrame:
    last = horizon_or_last(tables, horizon, completed_only=True)
    end = None if horizon is None else last
    runs = gap_runs(daily_item_sales(tables, grain, end), last, grain, min_days, lookback)
    return _named(runs, tables, grain)


def stock_gaps_calendar(
    tables: Tables,
    grain: tuple[str, ...] = STORE_ITEM,
    horizon: DateLike | None = None,
    min_days: int = 3,
    lookback: int = 14,
) -> DataFrame:
    """The same gaps from a calendar: days without a sale, grouped into islands."""
    last = horizon_or_last(tables, horizon, completed_only=True)
    daily = daily_item_sales(tables, grain, last)
    sold = daily.withColumnRenamed("fecha_venta", "fecha_calendario")
    silent = date_spine(daily, last, grain).join(
        sold.select(*grain, "fecha_calendario"), [*grain, "fecha_calendario"], "left_anti"
    )
    ordered = Window.partitionBy(*grain).orderBy("fecha_calendario")
    islands = silent.withColumn("island", F.date_sub("fecha_calendario", F.row_number().over(ordered)))
    runs = (
        islands.groupBy(*grain, "island")
        .agg(
            F.min("fecha_calendario").alias("fecha_inicio_ausencia"),
            F.max("fecha_calendario").alias("fecha_fin_ausencia"),
            F.count("*").alias("dias_sin_venta"),
        )
        .filter(F.col("dias_sin_venta") >= min_days)
        .drop("island")
    )
    # Each run starts the day after a sale, so the look-back is an equi join on that day with the
    # trailing sum already taken there.
    trailing = Window.partitionBy(*grain).orderBy("day_number").rangeBetween(-(lookback - 1), 0)
    before = sold.withColumn("day_number", F.unix_date("fecha_calendario")).select(
        *grain,
        F.date_add("fecha_calendario", 1).alias("fecha_inicio_ausencia"),
        F.sum("ventas_brutas").over(trailing).alias("before"),
    )
    scored = (
        runs.join(before, [*grain, "fecha_inicio_ausencia"])
        .withColumn("venta_diaria_promedio_previa", ratio("before", F.lit(lookback)))
        .withColumn("active_gap", F.col("fecha_fin_ausencia") == last)
    )
    return _named(scored, tables, grain)


# ---------------------------------------------------------------- roll-ups of a gap frame
def total_lost(column: str = "venta_estimada_perdida") -> Column:
    """Sum of estimates, each taken to six decimals: exact, so the order of rows cannot show."""
    return F.sum(F.col(column).cast("decimal(28,6)"))


def lost_sales_by(gaps: DataFrame, *keys: str) -> DataFrame:
    return gaps.groupBy(*keys).agg(total_lost().alias("ventas_estimadas_perdidas"))


def lost_sales_by_category(gaps: DataFrame, n: int | None = None) -> DataFrame:
    return _leading(lost_sales_by(gaps, "category"), n, "category")


def lost_sales_by_vendor(gaps: DataFrame, n: int | None = 5) -> DataFrame:
    return _leading(lost_sales_by(gaps, "vendor_id", "vendor_name"), n, "vendor_id")


def _leading(totals: DataFrame, n: int | None, tie: str) -> DataFrame:
    ordered = totals.orderBy(F.col("ventas_estimadas_perdidas").desc(), tie)
    return ordered if n is None else ordered.limit(n)


def top_gaps(gaps: DataFrame, n: int = 1000, active_only: bool = False, grain: tuple[str, ...] = STORE_ITEM) -> DataFrame:
    """The costliest gaps: a report of fixed length."""
    rows = gaps.filter("active_gap") if active_only else gaps
    return rows.orderBy(F.col("venta_estimada_perdida").desc(), *grain, "fecha_inicio_ausencia").limit(n)


def gap_totals(gaps: DataFrame) -> DataFrame:
    return gaps.agg(
        F.count("*").alias("ausencias"),
        F.count_if("active_gap").alias("ausencias_activas"),
        total_lost().alias("ventas_estimadas_perdidas"),
    )
