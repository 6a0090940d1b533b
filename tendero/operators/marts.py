"""Star schema: facts at item, ticket, store-day, gap and cohort-month grain, and dimensions.

Surrogate keys are hashes of the natural key, so every fact and dimension is an independent job
and no key lookup join is needed to build a fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendero.functions import line_amount, money, net_amount, ratio, signed, surrogate_key, transaction_count, week_start
from tendero.operators.base import DateLike
from tendero.operators.cohorts import cohort_activity
from tendero.operators.stockgaps import STORE_ITEM, stock_gaps
from tendero.schemas import COMPLETED, RETURNED, Tables

ANONYMOUS_KEY = "-1"
PROMOTION_COLUMNS = ("promo_name", "variant", "start_date", "end_date", "promo_type")


def date_key(day: str | Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def customer_hash(customer: str | Column, salt: str) -> Column:
    text = (F.col(customer) if isinstance(customer, str) else customer).cast("string")
    return F.sha2(F.concat(F.lit(salt), text), 256)


def customer_key(customer: str | Column, salt: str) -> Column:
    """The first 128 bits of the salted hash; anonymous buyers share one key."""
    return F.coalesce(F.substring(customer_hash(customer, salt), 1, 32), F.lit(ANONYMOUS_KEY))


# ---------------------------------------------------------------- dimensions
def dim_date(tables: Tables, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """One row per day of the period; the fiscal week is the ISO week."""
    span = tables["transactions"].agg(F.min("transaction_date").alias("lo"), F.max("transaction_date").alias("hi"))
    lo = F.col("lo") if start is None else F.lit(start).cast("date")
    hi = F.col("hi") if end is None else F.lit(end).cast("date")
    day = F.col("fecha")
    return span.select(F.explode(F.sequence(lo, hi)).alias("fecha")).select(
        date_key("fecha").alias("date_key"),
        "fecha",
        week_start("fecha").alias("inicio_semana"),
        F.month(day).cast("long").alias("mes"),
        F.quarter(day).cast("long").alias("trimestre"),
        F.year(day).cast("long").alias("anio"),
        F.weekofyear(day).cast("long").alias("semana_fiscal"),
    )


def dim_store(tables: Tables) -> DataFrame:
    return tables["stores"].select(
        surrogate_key("store_id").alias("store_key"),
        "store_id", "store_name", "country", "city", "format", "size_sqm", "opening_date", "region",
    )


def dim_product(tables: Tables) -> DataFrame:
    vendor = F.when(F.col("vendor_id").isNotNull(), surrogate_key("vendor_id"))
    return tables["products"].select(
        surrogate_key("item_id").alias("product_key"),
        "item_id", "item_name", "brand", vendor.alias("vendor_key"), "category", "department", "cost",
    )


def dim_vendor(tables: Tables) -> DataFrame:
    return tables["vendors"].select(
        surrogate_key("vendor_id").alias("vendor_key"),
        "vendor_id", "vendor_name", "country", "tier", "is_shared_catalog",
    )


def dim_customer(tables: Tables, salt: str) -> DataFrame:
    """Hashed customers with their loyalty segment and first purchase month.  The customer id
    itself does not leave this function."""
    bought = F.col("loyalty_card") & (F.col("status") == COMPLETED)
    customers = (
        tables["transactions"]
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.bool_or("loyalty_card").alias("loyal"),
            F.trunc(F.min(F.when(bought, F.col("transaction_date"))), "MM").alias("mes_primera_compra"),
        )
    )
    known = customers.select(
        customer_key("customer_id", salt).alias("customer_key"),
        customer_hash("customer_id", salt).alias("customer_hash"),
        F.when(F.col("loyal"), "LEALTAD").otherwise("SIN_TARJETA").alias("segmento_lealtad"),
        "mes_primera_compra",
    )
    anonymous = known.sparkSession.range(1).select(
        F.lit(ANONYMOUS_KEY).alias("customer_key"),
        F.lit(None).cast("string").alias("customer_hash"),
        F.lit("ANONIMO").alias("segmento_lealtad"),
        F.lit(None).cast("date").alias("mes_primera_compra"),
    )
    return known.unionByName(anonymous)


def dim_promotion(tables: Tables) -> DataFrame:
    distinct = tables["store_promotions"].select(*PROMOTION_COLUMNS).distinct()
    return distinct.select(surrogate_key(*PROMOTION_COLUMNS).alias("promotion_key"), *PROMOTION_COLUMNS)


# ---------------------------------------------------------------- facts
def promotion_days(tables: Tables) -> DataFrame:
    """(store, day) covered by promotions.  Windows expand to days so the sales join is a plain
    equi join that keeps its grain; where a store has two promotions on a day the key stays NULL
    and the count shows the ambiguity.  Windows are cut to the days that have sales, so an
    open-ended promotion stays small."""
    sold = tables["transactions"]
    first = F.greatest("start_date", sold.agg(F.min("transaction_date")).scalar())
    last = F.least("end_date", sold.agg(F.max("transaction_date")).scalar())
    days = (
        tables["store_promotions"]
        .select("store_id", *PROMOTION_COLUMNS, first.alias("first_day"), last.alias("last_day"))
        .filter(F.col("first_day") <= F.col("last_day"))
        .select(
            "store_id",
            surrogate_key(*PROMOTION_COLUMNS).alias("promotion_key"),
            F.explode(F.sequence("first_day", "last_day")).alias("transaction_date"),
        )
    )
    return days.groupBy("store_id", "transaction_date").agg(
        F.count_distinct("promotion_key").alias("promotions"),
        F.min("promotion_key").alias("only_key"),
    ).select(
        "store_id", "transaction_date", "promotions",
        F.when(F.col("promotions") == 1, F.col("only_key")).alias("promotion_key"),
    )


def fact_sales_item(tables: Tables, salt: str) -> DataFrame:
    """One row per item line.  Keys are hashed where rows are fewest: store and customer keys on the
    tickets, product keys on the products; only a line of an unknown item hashes its own."""
    day = ["store_id", "transaction_date"]
    tickets = tables["transactions"].join(promotion_days(tables), day, "left").select(
        "transaction_id", "status",
        date_key("transaction_date").alias("date_key"),
        surrogate_key("store_id").alias("store_key"),
        customer_key("customer_id", salt).alias("customer_key"),
        "promotion_key",
        F.coalesce("promotions", F.lit(0)).alias("promociones_vigentes"),
    )
    products = tables["products"].select(
        "item_id", surrogate_key("item_id").alias("product_key"), F.col("cost").cast("decimal(18,6)").alias("cost")
    )
    gross = line_amount()
    margin = signed(gross - F.col("quantity") * F.col("cost"))
    return tables["transaction_items"].join(products, "item_id", "left").join(tickets, "transaction_id").select(
        "transaction_item_id", "transaction_id", "date_key", "store_key",
        F.coalesce("product_key", surrogate_key("item_id")).alias("product_key"),
        "customer_key", "promotion_key", "promociones_vigentes", "quantity", "unit_price",
        gross.alias("ventas_brutas_item"),
        signed(gross).alias("ventas_netas_item"),
        F.col("cost").alias("costo_unitario"),
        margin.alias("margen_bruto"),
    )


def fact_transaction(tables: Tables, salt: str) -> DataFrame:
    return tables["transactions"].select(
        "transaction_id",
        date_key("transaction_date").alias("date_key"),
        surrogate_key("store_id").alias("store_key"),
        customer_key("customer_id", salt).alias("customer_key"),
        "payment_method", "status", "total_amount",
        net_amount().alias("ventas_netas"),
        "loyalty_card",
    )


def fact_store_day(tables: Tables, unique_ids: bool = False) -> DataFrame:
    returned = F.when(F.col("status") == RETURNED, money("total_amount"))
    daily = tables["transactions"].groupBy("transaction_date", "store_id").agg(
        F.sum(net_amount()).alias("ventas_netas"),
        transaction_count(unique_ids).alias("transacciones"),
        F.coalesce(F.sum(returned), F.lit(0).cast("decimal(18,2)")).alias("monto_devoluciones"),
    )
    return daily.join(tables["stores"].select("store_id", "size_sqm"), "store_id").select(
        date_key("transaction_date").alias("date_key"),
        surrogate_key("store_id").alias("store_key"),
        "ventas_netas", "transacciones",
        ratio("ventas_netas", "transacciones").alias("ticket_promedio"),
        ratio("ventas_netas", "size_sqm").alias("ventas_netas_por_metro_cuadrado"),
        "monto_devoluciones",
    )


def fact_stock_gap(
    tables: Tables, horizon: DateLike | None = None, grain: tuple[str, ...] = STORE_ITEM
) -> DataFrame:
    keys = {"store_id": "store_key", "item_id": "product_key", "vendor_id": "vendor_key"}
    surrogates = [surrogate_key(c).alias(keys[c]) if c in keys else F.col(c) for c in grain]
    return stock_gaps(tables, grain, horizon).select(
        *surrogates, "fecha_inicio_ausencia", "fecha_fin_ausencia", "dias_sin_venta",
        "venta_diaria_promedio_previa", "venta_estimada_perdida",
    )


def fact_cohort_month(tables: Tables) -> DataFrame:
    return cohort_activity(tables, months=None).select(
        F.date_format("mes_cohorte", "yyyyMM").alias("cohort_month_key"),
        "mes_relativo", "clientes_activos", "tasa_retencion", "ticket_promedio",
    )
