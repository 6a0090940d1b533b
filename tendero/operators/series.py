"""KPIs as series in the frequency they are watched: daily, weekly or monthly.

Daily figures come from a sweep over events, never from a calendar of items.  A selling gap or a spell of
activity is two events, a rise where it begins and a fall where it ends.  Events are added up by store and
day before they move, and a running sum over the days of a store, at most as many as the period has,
gives the level of each day.  A day without events keeps the level; only then are the days of a store
written out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tendero.functions import net_amount, ratio, transaction_count, week_start
from tendero.operators.base import DateLike, as_date, between_dates, completed_lines
from tendero.operators.kpis import (
    AVAILABILITY_TARGET, MARGIN_TARGET, STOCKOUT_TARGET, health_scores,
)
from tendero.operators.stockgaps import STORE_ITEM, grain_lines, stock_gaps
from tendero.schemas import NO_VENDOR, Tables

LOSS_TYPE = "decimal(38,6)"


def levels(events: DataFrame, keys: tuple[str, ...], values: tuple[str, ...], start: Column, end: Column) -> DataFrame:
    """From events (keys, date, changes of ``values``): the level of each key and day from ``start`` to
    ``end``, beginning with the key's first event.  Events before ``start`` count on that day."""
    changes = (
        events.filter(F.col("date") <= end)
        .groupBy(*keys, F.greatest(F.col("date"), start).alias("date"))
        .agg(*[F.sum(v).alias(v) for v in values])
    )
    by_key = Window.partitionBy(*keys).orderBy("date")
    up_to = by_key.rowsBetween(Window.unboundedPreceding, 0)
    until = F.coalesce(F.date_sub(F.lead("date").over(by_key), 1), end)
    held = changes.select(*keys, "date", until.alias("until"), *[F.sum(v).over(up_to).alias(v) for v in values])
    return held.select(*keys, F.explode(F.sequence("date", "until")).alias("date"), *values)


# ---------------------------------------------------------------- availability
def availability_events(
    tables: Tables, grain: tuple[str, ...], start: Column, end: Column, active_days: int, idle_days: int
) -> DataFrame:
    """(store_id, date, active, idle): an item is active from a sale until ``active_days`` after it, and
    idle from ``idle_days`` after it, each until its next sale."""
    sold = grain_lines(tables, grain, F.date_sub(start, active_days), end).select(
        *grain, F.col("transaction_date").alias("sold")
    )
    following = F.lead("sold").over(Window.partitionBy(*grain).orderBy("sold"))
    spells = sold.distinct().withColumn("next_sold", following).select(
        "store_id", "sold",
        F.least(F.coalesce("next_sold", F.date_add("sold", active_days + 1)), F.date_add("sold", active_days + 1)).alias("over"),
    )
    idles = F.date_add("sold", idle_days) < F.col("over")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    idle = F.when(idles, one).otherwise(none)

    def event(date: Column, active: Column, resting: Column) -> Column:
        return F.struct(date.alias("date"), active.alias("active"), resting.alias("idle"))

    events = F.array(
        event(F.col("sold"), one, none),
        event(F.date_add("sold", idle_days), none, idle),
        event(F.col("over"), -one, -idle),
    )
    return spells.select("store_id", F.explode(events).alias("e")).select("store_id", "e.*")


def kpi_availability_daily(
    tables: Tables,
    start: DateLike,
    end: DateLike,
    grain: tuple[str, ...] = STORE_ITEM,
    active_days: int = 180,
    idle_days: int = 3,
) -> DataFrame:
    """``kpi_availability`` of each day as its horizon, from one pass over the sales of the period and
    the ``active_days`` before it.  A store has no row on a day without active items."""
    first, last = as_date(start), as_date(end)
    events = availability_events(tables, grain, first, last, active_days, idle_days)
    return (
        levels(events, ("store_id",), ("active", "idle"), first, last)
        .filter(F.col("active") > 0)
        .select(
            "store_id", "date", F.col("active").alias("active_items"), F.col("idle").alias("idle_items"),
            (F.lit(1.0) - ratio("idle", "active")).alias("availability"),
        )
        .withColumn("meets_target", F.col("availability") >= AVAILABILITY_TARGET)
    )


# ---------------------------------------------------------------- lost sales
def loss_events(gaps: DataFrame) -> DataFrame:
    """(store_id, date, lost) from a gap frame: a gap's daily loss is added at its start and taken off after
    its end.  What rounding leaves falls on its last day, so that the days of a gap add up to its loss."""
    daily = F.col("venta_diaria_promedio_previa").cast("decimal(28,6)").cast(LOSS_TYPE)
    total = F.col("venta_estimada_perdida").cast("decimal(28,6)").cast(LOSS_TYPE)
    rest = (total - (daily * F.col("dias_sin_venta").cast("decimal(9,0)")).cast(LOSS_TYPE)).cast(LOSS_TYPE)
    priced = gaps.select(
        "store_id", F.col("fecha_inicio_ausencia").alias("a"), F.col("fecha_fin_ausencia").alias("b"),
        daily.alias("daily"), rest.alias("rest"),
    )

    def event(date: Column, lost: Column) -> Column:
        return F.struct(date.alias("date"), lost.cast(LOSS_TYPE).alias("lost"))

    events = F.array(
        event(F.col("a"), F.col("daily")),
        event(F.col("b"), F.col("rest")),
        event(F.date_add("b", 1), -(F.col("daily") + F.col("rest"))),
    )
    return priced.select("store_id", F.explode(events).alias("e")).select("store_id", "e.*")


def kpi_stockout_daily(
    tables: Tables, start: DateLike, end: DateLike, grain: tuple[str, ...] = STORE_ITEM, horizon: DateLike | None = None
) -> DataFrame:
    """Estimated lost sales over net sales, by store and day.  Gaps are judged as of ``horizon`` (by default
    ``end``): their losses over all days are ``gap_totals``.  Days with neither have no row; without net sales
    the index is NULL."""
    first, last = as_date(start), as_date(end)
    gaps = stock_gaps(tables, grain, end if horizon is None else horizon)
    lost = levels(loss_events(gaps), ("store_id",), ("lost",), first, last).filter(F.col("lost") != 0)
    net = between_dates(tables["transactions"], start, end).groupBy("store_id", F.col("transaction_date").alias("date")).agg(
        F.sum(net_amount()).alias("net_sales")
    )
    joined = net.join(lost, ["store_id", "date"], "full_outer")
    index = ratio("lost", "net_sales")
    return joined.withColumn("lost", F.coalesce("lost", F.lit(0).cast(LOSS_TYPE))).select(
        "store_id", "date", "lost", "net_sales", index.alias("stockout_index"), (index < STOCKOUT_TARGET).alias("meets_target")
    )


# ---------------------------------------------------------------- margin return
def kpi_margin_return_monthly(tables: Tables) -> DataFrame:
    """Gross margin over cost by month, vendor and category."""
    month = F.trunc("transaction_date", "MM").alias("month")
    per_item = completed_lines(tables, ("transaction_date",)).groupBy(month, "item_id").agg(
        F.sum("line").alias("sales"), F.sum("quantity").alias("units")
    )
    products = tables["products"].select("item_id", "vendor_id", "category", F.col("cost").cast("decimal(18,6)"))
    grouped = per_item.join(products, "item_id").groupBy("month", "vendor_id", "category").agg(
        F.sum("sales").alias("ventas_brutas_items"),
        F.sum(F.col("units").cast("decimal(19,0)") * F.col("cost")).alias("costo_total"),
    )
    value = ratio(F.col("ventas_brutas_items") - F.col("costo_total"), "costo_total")
    return grouped.join(tables["vendors"].select("vendor_id", "vendor_name"), "vendor_id", "left").select(
        "month", "vendor_id", F.coalesce("vendor_name", F.lit(NO_VENDOR)).alias("vendor_name"), "category",
        "ventas_brutas_items", "costo_total", value.alias("retorno_margen_bruto_sobre_costo"),
        (value > MARGIN_TARGET).alias("meets_target"),
    )


# ---------------------------------------------------------------- health score
def kpi_health_score_weekly(
    tables: Tables,
    start: DateLike,
    end: DateLike,
    grain: tuple[str, ...] = STORE_ITEM,
    unique_ids: bool = False,
) -> DataFrame:
    """The composite score of each store and whole week inside the period.  Components are scaled within
    the week and format; availability is that of the week's last day."""
    first, last = as_date(start), as_date(end)
    week = week_start("transaction_date")
    whole = (week >= first) & (F.date_add(week, 6) <= last)
    totals = between_dates(tables["transactions"], start, end).filter(whole).groupBy(week.alias("week_start"), "store_id").agg(
        F.sum(net_amount()).alias("net"), transaction_count(unique_ids).alias("tx")
    )
    sunday = F.weekday("date") == 6
    available = kpi_availability_daily(tables, start, end, grain).filter(sunday).select(
        F.date_sub("date", 6).alias("week_start"), "store_id", "availability"
    )
    parts = (
        totals.join(tables["stores"].select("store_id", "format", "size_sqm"), "store_id")
        .join(available, ["week_start", "store_id"], "left")
        .select(
            "week_start", "store_id", "format",
            ratio("net", "size_sqm").alias("sales_per_sqm"), ratio("tx", "size_sqm").alias("tx_per_sqm"),
            ratio("net", "tx").alias("ticket"), "availability",
        )
    )
    return health_scores(parts, "week_start", "format")
