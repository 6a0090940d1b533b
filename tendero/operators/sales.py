"""Comparable sales, store productivity and net-sales reports.

Facts are reduced to store grain before a dimension is joined, so what crosses the network is one
row per store and task, whatever share of the tickets one store holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tendero.functions import average_ticket, money_sum, net_amount, ratio, transaction_count
from tendero.operators.base import DateLike, as_date, between_dates, completed_lines, horizon_or_last, union_all
from tendero.schemas import LOW_PERFORMANCE, OK, RETURNED, Tables

CURRENT, PREVIOUS = "ventas_netas_periodo_actual", "ventas_netas_periodo_anterior"
GROWTH, RANK = "crecimiento_ventas_comparables_pct", "ranking_crecimiento_tienda_formato"
PER_SQM, TX_PER_SQM = "ventas_netas_por_metro_cuadrado", "transacciones_por_metro_cuadrado"
P25 = "percentil_25_ventas_por_metro_cuadrado"


# ---------------------------------------------------------------- comparable sales
def comp_sales_store(
    tables: Tables,
    current_start: DateLike,
    current_end: DateLike,
    previous_start: DateLike | None = None,
    previous_end: DateLike | None = None,
) -> DataFrame:
    """Net sales of a period against the same period a year before, for stores that were open at
    the start of the earlier one and sold in both."""
    start, end = as_date(current_start), as_date(current_end)
    before_start = F.add_months(start, -12) if previous_start is None else as_date(previous_start)
    before_end = F.add_months(end, -12) if previous_end is None else as_date(previous_end)
    day = F.col("transaction_date")
    now, before = day.between(start, end), day.between(before_start, before_end)
    nothing = F.lit(0).cast("decimal(18,2)")

    per_store = (
        tables["transactions"]
        .filter(now | before)
        .groupBy("store_id")
        .agg(
            F.sum(F.when(now, net_amount()).otherwise(nothing)).alias(CURRENT),
            F.sum(F.when(before, net_amount()).otherwise(nothing)).alias(PREVIOUS),
        )
        .filter((F.col(CURRENT) != 0) & (F.col(PREVIOUS) != 0))
    )
    comparable = tables["stores"].filter(F.col("opening_date") <= before_start)
    by_growth = Window.partitionBy("format").orderBy(F.col(GROWTH).desc())
    return (
        per_store.join(comparable.select("store_id", "store_name", "country", "format"), "store_id")
        .withColumn(GROWTH, ratio(CURRENT, PREVIOUS) - 1)
        .select(
            "country", "format", "store_id", "store_name", CURRENT, PREVIOUS, GROWTH,
            F.dense_rank().over(by_growth).cast("long").alias(RANK),
        )
    )


def _growth_totals(grouped) -> DataFrame:
    return grouped.agg(
        F.sum(CURRENT).alias("gmv_current"),
        F.sum(PREVIOUS).alias("gmv_previous"),
        F.count_distinct("store_id").alias("stores"),
    ).withColumn("growth_pct", ratio("gmv_current", "gmv_previous") - 1)


def comp_sales_country_format(comparable: DataFrame) -> DataFrame:
    return _growth_totals(comparable.groupBy("country", "format"))


def comp_sales_by(comparable: DataFrame, level: str) -> DataFrame:
    return _growth_totals(comparable.groupBy(level))


def comp_sales_levels(comparable: DataFrame) -> DataFrame:
    """Growth by format, by country and in total, in one pass over the store rows."""
    keys = [F.col("format"), F.col("country")]
    sets = [[F.col("format")], [F.col("country")], []]
    levels = comparable.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("level_id"),
        F.sum(CURRENT).alias("gmv_current"),
        F.sum(PREVIOUS).alias("gmv_previous"),
    )
    name = F.when(F.col("level_id") == 1, "format").when(F.col("level_id") == 2, "country").otherwise("total")
    return levels.select(
        name.alias("level"),
        F.coalesce("format", "country", F.lit("ALL")).alias("member"),
        "gmv_current",
        "gmv_previous",
        (ratio("gmv_current", "gmv_previous") - 1).alias("growth_pct"),
    )


def comp_sales_extremes(comparable: DataFrame, n: int = 4) -> DataFrame:
    """The ``n`` fastest and ``n`` slowest growing stores; position 1 is the best or worst."""
    growth = F.col(GROWTH)

    def pick(order: Column, name: str) -> DataFrame:
        chosen = comparable.orderBy(order, "store_id").limit(n).withColumn("extremo", F.lit(name))
        position = Window.partitionBy("extremo").orderBy(order, "store_id")
        return chosen.withColumn("posicion", F.row_number().over(position).cast("long"))

    both = union_all([pick(growth.desc(), "MEJOR"), pick(growth.asc(), "PEOR")])
    return both.select("extremo", "posicion", "store_id", "store_name", "country", "format", CURRENT, GROWTH)


# ---------------------------------------------------------------- productivity
def _store_totals(
    tables: Tables, start: DateLike | None, end: DateLike | None, unique_ids: bool, positive_tickets: bool
) -> DataFrame:
    per_store = (
        between_dates(tables["transactions"], start, end)
        .groupBy("store_id")
        .agg(
            F.sum(net_amount()).alias("ventas_netas"),
            transaction_count(unique_ids).alias("transacciones"),
            average_ticket(unique_ids, positive_tickets).alias("ticket_promedio"),
        )
    )
    attributes = ("store_id", "store_name", "country", "format", "region", "size_sqm")
    return per_store.join(tables["stores"].select(*attributes), "store_id").withColumns(
        {
            PER_SQM: ratio("ventas_netas", "size_sqm"),
            TX_PER_SQM: ratio("transacciones", "size_sqm"),
        }
    )


def _lower_position(scored: DataFrame, pct: float) -> DataFrame:
    """Percentile as the value at the truncated position, without interpolation."""
    in_format = Window.partitionBy("format")
    ordered = scored.withColumns(
        {
            "_position": F.row_number().over(in_format.orderBy(F.col(PER_SQM), "store_id")),
            "_stores": F.count("*").over(in_format),
        }
    )
    wanted = F.floor((F.col("_stores") - 1) * F.lit(pct)) + 1
    picked = F.when(F.col("_position") == wanted, F.col(PER_SQM))
    return ordered.withColumn(P25, F.max(picked).over(in_format)).drop("_position", "_stores")


def store_productivity(
    tables: Tables,
    start: DateLike | None = None,
    end: DateLike | None = None,
    pct: float = 0.25,
    method: str = "linear",
    unique_ids: bool = False,
    positive_tickets: bool = False,
) -> DataFrame:
    """Sales and tickets per square metre with the format's percentile, rank and alert.  Without
    dates the quarter holding the newest transaction is used.  ``unique_ids`` trusts the ticket
    key; ``positive_tickets`` keeps zero and negative totals out of the average ticket."""
    last = horizon_or_last(tables, end)
    first = F.trunc(last, "quarter") if start is None else as_date(start)
    scored = _store_totals(tables, first, last, unique_ids, positive_tickets)
    in_format = Window.partitionBy("format")
    if method == "linear":
        scored = scored.withColumn(P25, F.percentile(PER_SQM, pct).over(in_format))
    elif method == "lower":
        scored = _lower_position(scored, pct)
    else:
        raise ValueError(f"unknown percentile method: {method}")
    low = F.col(PER_SQM) < F.col(P25)
    return scored.withColumns(
        {
            "ranking_en_formato": F.dense_rank().over(in_format.orderBy(F.col(PER_SQM).desc())).cast("long"),
            "alerta_rendimiento": F.when(low, LOW_PERFORMANCE).otherwise(OK),
        }
    )


def productivity_bottom_n(productivity: DataFrame, n: int = 12) -> DataFrame:
    columns = (
        "store_id", "store_name", "country", "format", "region", "ventas_netas", PER_SQM,
        "ticket_promedio", "alerta_rendimiento",
    )
    return productivity.select(*columns).orderBy(F.col(PER_SQM).asc_nulls_last(), "store_id").limit(n)


def low_stores_by_format(productivity: DataFrame) -> DataFrame:
    """Flagged stores by format, with the overall count on the ``TOTAL`` row."""
    flagged = productivity.filter(F.col("alerta_rendimiento") == LOW_PERFORMANCE)
    return flagged.rollup("format").agg(F.count("*").alias("tiendas"), F.grouping("format").alias("_all")).select(
        F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col("format")).alias("format"), "tiendas"
    )


# ---------------------------------------------------------------- net sales reports
def net_sales_total(tables: Tables) -> DataFrame:
    return tables["transactions"].agg(F.sum(net_amount()).alias("ventas_netas"))


def net_sales_by(
    tables: Tables, keys: tuple[str, ...], unique_ids: bool = False, positive_tickets: bool = False
) -> DataFrame:
    """Net sales, tickets and average ticket by store attributes."""
    per_store_keys = tables["stores"].select("store_id", *keys)
    return tables["transactions"].join(per_store_keys, "store_id").groupBy(*keys).agg(
        F.sum(net_amount()).alias("ventas_netas"),
        transaction_count(unique_ids).alias("transacciones"),
        average_ticket(unique_ids, positive_tickets).alias("ticket_promedio"),
    )


def net_sales_by_format(tables: Tables, **options: bool) -> DataFrame:
    return net_sales_by(tables, ("format",), **options)


def net_sales_by_country_format(tables: Tables, **options: bool) -> DataFrame:
    return net_sales_by(tables, ("country", "format"), **options)


def top_stores(tables: Tables, n: int = 10) -> DataFrame:
    per_store = tables["transactions"].groupBy("store_id").agg(F.sum(net_amount()).alias("ventas_netas"))
    names = tables["stores"].select("store_id", "store_name", "country", "format")
    named = per_store.join(names, "store_id").select("store_id", "store_name", "country", "format", "ventas_netas")
    return named.orderBy(F.col("ventas_netas").desc(), "store_id").limit(n)


def returns_by_format(tables: Tables) -> DataFrame:
    returned = tables["transactions"].filter(F.col("status") == RETURNED)
    per_store = returned.groupBy("store_id").agg(F.count("*").alias("n"), money_sum("total_amount").alias("amount"))
    return (
        per_store.join(tables["stores"].select("store_id", "format"), "store_id")
        .groupBy("format")
        .agg(F.sum("n").alias("transacciones_devueltas"), F.sum("amount").alias("monto_devuelto"))
    )


def stores_by_format(tables: Tables) -> DataFrame:
    return tables["stores"].groupBy("format").agg(F.count("*").alias("tiendas"))


def category_sales(tables: Tables) -> DataFrame:
    """Completed gross item sales and units by category, reduced to item grain first."""
    per_item = completed_lines(tables, ()).groupBy("item_id").agg(
        F.sum("line").alias("line"), F.sum("quantity").alias("units")
    )
    return (
        per_item.join(tables["products"].select("item_id", "category"), "item_id")
        .groupBy("category")
        .agg(F.sum("line").alias("ventas_brutas"), F.sum("units").alias("unidades"))
    )


# ---------------------------------------------------------------- store x day
def store_day(
    tables: Tables,
    country: str | None = None,
    format: str | None = None,
    region: str | None = None,
    store_id: object = None,
    start: DateLike | None = None,
    end: DateLike | None = None,
    unique_ids: bool = False,
) -> DataFrame:
    """Net sales and tickets by store and day; every argument is an optional selector."""
    stores = tables["stores"].select("store_id", "store_name", "country", "format", "region", "size_sqm")
    for name, value in (("country", country), ("format", format), ("region", region), ("store_id", store_id)):
        if value is not None:
            stores = stores.filter(F.col(name) == F.lit(value))
    tx = between_dates(tables["transactions"], start, end)
    if store_id is not None:
        tx = tx.filter(F.col("store_id") == F.lit(store_id))
    elif country is not None or format is not None or region is not None:
        tx = tx.join(stores.select("store_id"), "store_id", "left_semi")
    daily = tx.groupBy("transaction_date", "store_id").agg(
        F.sum(net_amount()).alias("gmv"), transaction_count(unique_ids).alias("tx")
    )
    return daily.join(stores, "store_id").select(
        F.col("transaction_date").alias("date"),
        "store_id", "store_name", "country", "format", "region", "size_sqm", "gmv", "tx",
    )
