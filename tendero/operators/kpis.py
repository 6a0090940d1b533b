"""KPI frames: the indicator, its target and whether the target is met."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tendero.functions import net_amount, ratio, transaction_count, week_start
from tendero.operators.base import DateLike, between_dates, horizon_or_last
from tendero.operators.cohorts import cohort_activity
from tendero.operators.mix import vendor_margin_return
from tendero.operators.stockgaps import grain_lines, stock_gaps, total_lost
from tendero.schemas import Tables

# Suggested targets, and the weights of the health score.
LOYALTY_TARGET = 0.45
RETENTION_TARGET = 0.70
STOCKOUT_TARGET = 0.02
MARGIN_TARGET = 1.5
AVAILABILITY_TARGET = 0.97
TICKET_GROWTH_TARGET = 0.03
HEALTH_TARGET = 75.0
HEALTH_WEIGHTS = {"sales_per_sqm": 0.40, "tx_per_sqm": 0.25, "ticket": 0.20, "availability": 0.15}


def _store_weeks(tables: Tables, unique_ids: bool) -> DataFrame:
    weekly = tables["transactions"].groupBy(
        week_start("transaction_date").alias("week_start"), "store_id"
    ).agg(F.sum(net_amount()).alias("net"), transaction_count(unique_ids).alias("tx"))
    return weekly.join(tables["stores"].select("store_id", "format", "size_sqm"), "store_id")


def _against_median(weekly: DataFrame, value: Column) -> DataFrame:
    peers = Window.partitionBy("week_start", "format")
    return (
        weekly.withColumn("value", value)
        .withColumn("p50_format", F.percentile("value", 0.5).over(peers))
        .select(
            "week_start", "store_id", "format", "value", "p50_format",
            (F.col("value") >= F.col("p50_format")).alias("meets_target"),
        )
    )


def kpi_sales_per_sqm(tables: Tables) -> DataFrame:
    """Weekly net sales per square metre against the median of the format."""
    return _against_median(_store_weeks(tables, unique_ids=True), ratio("net", "size_sqm"))


def kpi_tx_per_sqm(tables: Tables, unique_ids: bool = False) -> DataFrame:
    return _against_median(_store_weeks(tables, unique_ids), ratio("tx", "size_sqm"))


def kpi_avg_ticket(tables: Tables, unique_ids: bool = False) -> DataFrame:
    """Daily net ticket and its growth over the same day a year earlier."""
    daily = tables["transactions"].groupBy("transaction_date").agg(
        F.sum(net_amount()).alias("net"), transaction_count(unique_ids).alias("tx")
    ).select(F.col("transaction_date").alias("date"), ratio("net", "tx").alias("ticket"))
    before = daily.select(F.col("date").alias("previous_date"), F.col("ticket").alias("previous_ticket"))
    return (
        daily.withColumn("previous_date", F.add_months("date", -12))
        .join(before, "previous_date", "left")
        .withColumn("growth", ratio("ticket", "previous_ticket") - 1)
        .select(
            "date", "ticket", "previous_ticket", "growth",
            (F.col("growth") >= TICKET_GROWTH_TARGET).alias("meets_target"),
        )
    )


def kpi_loyalty_conversion(tables: Tables) -> DataFrame:
    """Weekly share of tickets with a loyalty card."""
    weekly = tables["transactions"].groupBy(week_start("transaction_date").alias("week_start")).agg(
        F.count_if("loyalty_card").alias("loyalty_tx"), F.count("*").alias("tx")
    )
    return weekly.withColumn("conversion", ratio("loyalty_tx", "tx")).withColumn(
        "meets_target", F.col("conversion") >= LOYALTY_TARGET
    )


def kpi_retention_m1(tables: Tables) -> DataFrame:
    return cohort_activity(tables, (1,)).select(
        "mes_cohorte", "clientes_activos", "clientes_cohorte", "tasa_retencion",
        (F.col("tasa_retencion") >= RETENTION_TARGET).alias("meets_target"),
    )


def kpi_stockout_index(
    tables: Tables, horizon: DateLike | None = None, grain: tuple[str, ...] = ("store_id", "item_id")
) -> DataFrame:
    """Estimated lost sales over net sales, by store."""
    lost = stock_gaps(tables, grain, horizon).groupBy("store_id").agg(total_lost().alias("lost"))
    net = between_dates(tables["transactions"], None, horizon).groupBy("store_id").agg(
        F.sum(net_amount()).alias("net_sales")
    )
    joined = net.join(lost, "store_id", "left").withColumn("lost", F.coalesce("lost", F.lit(0).cast("decimal(38,6)")))
    return joined.withColumn("stockout_index", ratio("lost", "net_sales")).select(
        "store_id", "lost", "net_sales", "stockout_index",
        (F.col("stockout_index") < STOCKOUT_TARGET).alias("meets_target"),
    )


def kpi_margin_return(tables: Tables) -> DataFrame:
    value = F.col("retorno_margen_bruto_sobre_costo")
    return vendor_margin_return(tables).select(
        "vendor_id", "vendor_name", "category", value, (value > MARGIN_TARGET).alias("meets_target")
    )


def kpi_availability(
    tables: Tables,
    horizon: DateLike | None = None,
    grain: tuple[str, ...] = ("store_id", "item_id"),
    active_days: int = 180,
    idle_days: int = 3,
) -> DataFrame:
    """Share of a store's active items that are selling: active means sold within
    ``active_days`` of the horizon, idle means no sale in the last ``idle_days`` days.  Only those
    days of sales are read: an item whose last sale is older is not active anyway."""
    last = horizon_or_last(tables, horizon, completed_only=True)
    recent = grain_lines(tables, grain, F.date_sub(last, active_days), last)
    active = recent.groupBy(*grain).agg(F.max("transaction_date").alias("last_day"))
    silent_days = F.datediff(last, F.col("last_day"))
    return (
        active.groupBy("store_id")
        .agg(F.count("*").alias("active_items"), F.count_if(silent_days >= idle_days).alias("idle_items"))
        .withColumn("availability", F.lit(1.0) - ratio("idle_items", "active_items"))
        .withColumn("meets_target", F.col("availability") >= AVAILABILITY_TARGET)
    )


def health_scores(parts: DataFrame, *peer_columns: str) -> DataFrame:
    """The weighted sum of the components of ``HEALTH_WEIGHTS``, each min-max scaled among its peers."""
    peers = Window.partitionBy(*peer_columns)

    def scaled(name: str) -> Column:
        low, high = F.min(name).over(peers), F.max(name).over(peers)
        return ratio(F.col(name) - low, high - low)

    parts = parts.withColumns({f"{name}_scaled": scaled(name) for name in HEALTH_WEIGHTS})
    score = sum((F.col(f"{name}_scaled") * weight for name, weight in HEALTH_WEIGHTS.items()), F.lit(0.0))
    return parts.withColumn("health_score", score * 100).withColumn(
        "meets_target", F.col("health_score") >= HEALTH_TARGET
    )


def kpi_health_score(
    tables: Tables,
    start: DateLike,
    end: DateLike,
    grain: tuple[str, ...] = ("store_id", "item_id"),
    unique_ids: bool = False,
) -> DataFrame:
    """Composite score out of 100 per store.  Each component is min-max scaled inside its format;
    a missing component, or one equal across the format, leaves the score NULL."""
    totals = between_dates(tables["transactions"], start, end).groupBy("store_id").agg(
        F.sum(net_amount()).alias("net"), transaction_count(unique_ids).alias("tx")
    )
    base = (
        totals.join(tables["stores"].select("store_id", "format", "size_sqm"), "store_id")
        .join(kpi_availability(tables, end, grain).select("store_id", "availability"), "store_id", "left")
        .select(
            "store_id", "format",
            ratio("net", "size_sqm").alias("sales_per_sqm"),
            ratio("tx", "size_sqm").alias("tx_per_sqm"),
            ratio("net", "tx").alias("ticket"),
            "availability",
        )
    )
    return health_scores(base, "format")
