"""Category mix, vendor margin, promotions and category priorities.

Item-grain work first reduces lines to (item) or (format, item) with map-side combine; product
and vendor attributes join afterwards, so one hot item or one hot ticket never lands whole on a
single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tendero.functions import line_amount, money, ratio, signed
from tendero.operators.base import TICKET_LINES, DateLike, completed, completed_lines, horizon_or_last
from tendero.schemas import (
    LOW_MARGIN_RETURN,
    MONITORING,
    NO_VENDOR,
    OK,
    PRIORITY_HIGH,
    PRIORITY_MEDIUM,
    PROMO_UNCLEAR,
    PROMO_UNITS_ONLY,
    PROMO_UPLIFT,
    Tables,
)


# ---------------------------------------------------------------- Pareto and shares
def net_item_sales(tables: Tables) -> DataFrame:
    """Signed item sales by format and category, all statuses."""
    tickets = tables["transactions"].select("transaction_id", "store_id", "status")
    formats = tables["stores"].select("store_id", "format")
    lines = tables["transaction_items"].select("transaction_id", "item_id", line_amount().alias("line"))
    per_item = (
        lines.join(tickets, "transaction_id")
        .join(formats, "store_id")
        .groupBy("format", "item_id")
        .agg(F.sum(signed(F.col("line"))).alias("net"))
    )
    return (
        per_item.join(tables["products"].select("item_id", "category"), "item_id")
        .filter(F.col("format").isNotNull() & F.col("category").isNotNull())
        .groupBy("format", "category")
        .agg(F.sum("net").alias("net_line_gmv"))
    )


def pareto(tables: Tables) -> DataFrame:
    """Share of each category in its format, and the running share from the largest down."""
    in_format = Window.partitionBy("format")
    running = in_format.orderBy(F.col("net_line_gmv").desc(), "category").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("net_line_gmv").over(in_format)
    return net_item_sales(tables).select(
        "format", "category", "net_line_gmv",
        ratio("net_line_gmv", total).alias("share"),
        ratio(F.sum("net_line_gmv").over(running), total).alias("cum_share"),
    )


def pareto_top_categories(pareto_rows: DataFrame, n: int = 8) -> DataFrame:
    totals = pareto_rows.groupBy("category").agg(F.sum("net_line_gmv").alias("net_line_gmv"))
    return totals.orderBy(F.col("net_line_gmv").desc(), "category").limit(n)


def pareto_top_by_format(pareto_rows: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` leading categories of each format, shares in percent with one decimal."""
    order = Window.partitionBy("format").orderBy(F.col("net_line_gmv").desc(), "category")
    return (
        pareto_rows.withColumn("posicion", F.row_number().over(order).cast("long"))
        .filter(F.col("posicion") <= k)
        .select(
            "format", "category", "posicion",
            F.round(F.col("share") * 100, 1).alias("participacion_pct"),
            F.round(F.col("cum_share") * 100, 1).alias("participacion_acumulada_pct"),
        )
    )


def category_share(tables: Tables, category: str | None = None) -> DataFrame:
    """Share of each category (or of one) in all net item sales."""
    totals = net_item_sales(tables).groupBy("category").agg(F.sum("net_line_gmv").alias("net_line_gmv"))
    # A window over the few categories: a scalar subquery would read the facts a second time.
    shares = totals.withColumn("share", ratio("net_line_gmv", F.sum("net_line_gmv").over(Window.partitionBy(F.lit(1)))))
    return shares if category is None else shares.filter(F.col("category") == category)


# ---------------------------------------------------------------- vendor margin
def vendor_margin_return(
    tables: Tables, threshold: float = 1.0, keep_unknown_items: bool = False, low_label: str = LOW_MARGIN_RETURN
) -> DataFrame:
    """Gross margin over cost by vendor and category, with item count and units per day.

    Cost is a product attribute, so each item's cost total is its units times its cost: the
    product join needs one row per item instead of one per line, and since items are unique
    after that reduction, counting them needs no distinct.  Sold items that are missing from the
    product table are left out unless ``keep_unknown_items``."""
    per_item = completed_lines(tables, ("transaction_date",)).groupBy("item_id").agg(
        F.sum("line").alias("sales"),
        F.sum("quantity").alias("units"),
        F.min("transaction_date").alias("first_day"),
        F.max("transaction_date").alias("last_day"),
    )
    products = tables["products"].select("item_id", "vendor_id", "category", F.col("cost").cast("decimal(18,6)"))
    vendors = tables["vendors"].select("vendor_id", "vendor_name")
    margin = F.col("ventas_brutas_items") - F.col("costo_total")
    span = F.datediff("last_day", "first_day") + 1
    return (
        per_item.join(products, "item_id", "left" if keep_unknown_items else "inner")
        .groupBy("vendor_id", "category")
        .agg(
            F.sum("sales").alias("ventas_brutas_items"),
            F.sum(F.col("units").cast("decimal(19,0)") * F.col("cost")).alias("costo_total"),
            F.count("*").alias("items_activos"),
            F.sum("units").alias("units"),
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
        )
        .join(vendors, "vendor_id", "left")
        .withColumn("retorno_margen_bruto_sobre_costo", ratio(margin, "costo_total"))
        .select(
            "vendor_id",
            F.coalesce("vendor_name", F.lit(NO_VENDOR)).alias("vendor_name"),
            "category", "ventas_brutas_items", "costo_total",
            margin.alias("margen_bruto"),
            "retorno_margen_bruto_sobre_costo", "items_activos",
            ratio("units", span).alias("velocidad_unidades_por_dia"),
            F.when(F.col("retorno_margen_bruto_sobre_costo") < threshold, low_label)
            .otherwise(OK)
            .alias("alerta_retorno_margen"),
        )
    )


def vendor_margin_low_count(margins: DataFrame, threshold: float = 1.0) -> DataFrame:
    low = F.count_if(F.col("retorno_margen_bruto_sobre_costo") < threshold)
    return margins.agg(low.alias("proveedores_categoria_bajos"), F.count("*").alias("proveedores_categoria"))


def vendor_margin_worst(margins: DataFrame, n: int = 5) -> DataFrame:
    order = (F.col("retorno_margen_bruto_sobre_costo").asc_nulls_last(), "vendor_id", "category")
    columns = ("vendor_id", "vendor_name", "category", "retorno_margen_bruto_sobre_costo", "margen_bruto")
    return margins.select(*columns).orderBy(*order).limit(n)


# ---------------------------------------------------------------- promotions
def promo_impact_long(tables: Tables) -> DataFrame:
    """Averages per category and promotion flag over (ticket, category) pairs.

    Completed tickets are joined first, so returned ones are not carried on, and the join's
    partitioning by ticket serves the reduction to (ticket, category): lines move once.  Adaptive
    execution splits a ticket with very many lines.  A ticket counts once in each category."""
    products = tables["products"].select("item_id", "category")
    if TICKET_LINES in tables:
        told = tables[TICKET_LINES].join(products, "item_id")
    else:
        lines = tables["transaction_items"].select(
            "transaction_id", "item_id", "quantity", "was_on_promo", line_amount().alias("line")
        )
        tickets = completed(tables).select("transaction_id", money("total_amount").alias("ticket"))
        told = lines.join(products, "item_id").join(tickets, "transaction_id")
    pairs = (
        told.groupBy("transaction_id", "category")
        .agg(
            F.bool_or("was_on_promo").alias("promo_tx"),
            F.sum("quantity").alias("units"),
            F.sum("line").alias("line"),
            F.max("ticket").alias("ticket"),
        )
    )
    return (
        pairs.groupBy("category", "promo_tx")
        .agg(
            F.count("*").alias("transactions"),
            ratio(F.sum("line"), F.count("line")).alias("avg_category_gmv"),
            ratio(F.sum("units"), F.count("units")).alias("avg_units"),
            ratio(F.sum("ticket"), F.count("ticket")).alias("avg_ticket"),
        )
    )


def promo_impact(tables: Tables) -> DataFrame:
    """One row per category: with and without promotion, differences, and a reading."""

    def side(on_promo: bool, value: str) -> Column:
        return F.max(F.when(F.col("promo_tx") == on_promo, F.col(value)))

    paired = promo_impact_long(tables).groupBy("category").agg(
        side(True, "transactions").alias("transacciones_con_promocion"),
        side(False, "transactions").alias("transacciones_sin_promocion"),
        side(True, "avg_ticket").alias("ticket_promedio_con_promocion"),
        side(False, "avg_ticket").alias("ticket_promedio_sin_promocion"),
        side(True, "avg_units").alias("unidades_promedio_con_promocion"),
        side(False, "avg_units").alias("unidades_promedio_sin_promocion"),
        (side(True, "avg_category_gmv") - side(False, "avg_category_gmv")).alias(
            "diferencia_ventas_categoria_promedio"
        ),
    )
    tickets = F.col("ticket_promedio_con_promocion") - F.col("ticket_promedio_sin_promocion")
    units = F.col("unidades_promedio_con_promocion") - F.col("unidades_promedio_sin_promocion")
    more_units = F.col("unidades_promedio_con_promocion") > F.col("unidades_promedio_sin_promocion")
    ticket_holds = F.col("ticket_promedio_con_promocion") >= F.col("ticket_promedio_sin_promocion")
    return paired.withColumns(
        {
            "diferencia_ticket_promedio": tickets,
            "diferencia_unidades_promedio": units,
            "lectura_promocion": F.when(more_units & ticket_holds, PROMO_UPLIFT)
            .when(more_units, PROMO_UNITS_ONLY)
            .otherwise(PROMO_UNCLEAR),
        }
    )


def promo_impact_ranked(impact: DataFrame) -> DataFrame:
    return impact.select(
        "category",
        "ticket_promedio_con_promocion", "ticket_promedio_sin_promocion", "diferencia_ticket_promedio",
        "unidades_promedio_con_promocion", "unidades_promedio_sin_promocion", "diferencia_unidades_promedio",
        "lectura_promocion",
    ).orderBy(F.col("diferencia_unidades_promedio").desc_nulls_last(), "category")


# ---------------------------------------------------------------- priorities
def category_recommendation(
    tables: Tables, horizon: DateLike | None = None, idle_days: int = 3, share_cut: float = 0.20
) -> DataFrame:
    """Category sales share against store-items idle at the horizon.  One reduction to
    (store, item) serves both the sales and the last-sale date."""
    last = horizon_or_last(tables, horizon)
    pairs = completed_lines(tables).groupBy("store_id", "item_id").agg(
        F.sum("line").alias("line"), F.max("transaction_date").alias("last_day")
    )
    idle = F.count_if(F.datediff(last, F.col("last_day")) >= idle_days)
    by_category = (
        pairs.join(tables["products"].select("item_id", "category"), "item_id")
        .groupBy("category")
        .agg(F.sum("line").alias("ventas_brutas_categoria"), idle.alias("productos_tienda_con_gap_activo"))
    )
    overall = F.sum("ventas_brutas_categoria").over(Window.partitionBy(F.lit(1)))
    share, gaps = F.col("participacion_ventas"), F.col("productos_tienda_con_gap_activo")
    return by_category.withColumn("participacion_ventas", ratio("ventas_brutas_categoria", overall)).select(
        "category", "ventas_brutas_categoria", "participacion_ventas", "productos_tienda_con_gap_activo",
        F.when((share >= share_cut) & (gaps > 0), PRIORITY_HIGH)
        .when(gaps > 0, PRIORITY_MEDIUM)
        .otherwise(MONITORING)
        .alias("recomendacion"),
    )
