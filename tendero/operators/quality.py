"""Data-quality audit.

Single checks are operators of their own; ``dq_findings`` gives all of them as rows of
``(dimension, check, failed, total, pct, detail)``, where checks on one input share its scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tendero.functions import line_amount, money, month_index_diff, ratio, week_start
from tendero.operators.base import DateLike, completed, completed_lines, horizon_or_last, union_all
from tendero.operators.cohorts import cohort_activity, loyalty_months
from tendero.operators.experiments import multi_variant_stores
from tendero.schemas import RETURNED, TABLE_NAMES, WITH_CUSTOMER, WITHOUT_CUSTOMER, Tables


# ---------------------------------------------------------------- customers and cards
def dq_null_customer(tables: Tables) -> DataFrame:
    out = tables["transactions"].agg(
        F.count_if(F.col("customer_id").isNull()).alias("sin_cliente"), F.count("*").alias("total")
    )
    return out.withColumn("pct", ratio("sin_cliente", "total") * 100)


def dq_loyalty_consistency(tables: Tables) -> DataFrame:
    unknown, card = F.col("customer_id").isNull(), F.col("loyalty_card")
    return tables["transactions"].agg(
        F.count_if(unknown & card).alias("tarjeta_sin_cliente"),
        F.count_if(~unknown & ~card).alias("cliente_sin_tarjeta"),
    )


def dq_loyalty_matrix(tables: Tables) -> DataFrame:
    known = F.when(F.col("customer_id").isNull(), WITHOUT_CUSTOMER).otherwise(WITH_CUSTOMER)
    return tables["transactions"].groupBy("loyalty_card", known.alias("estado_cliente")).agg(
        F.count("*").alias("transacciones")
    )


# ---------------------------------------------------------------- amounts
def ticket_deltas(tables: Tables) -> DataFrame:
    """Reported total minus the sum of its lines.  Lines are summed before they meet the ticket,
    and the join reuses that partitioning.  The delta of a ticket without lines is NULL."""
    sums = tables["transaction_items"].groupBy("transaction_id").agg(F.sum(line_amount()).alias("items_total"))
    tickets = tables["transactions"].select("transaction_id", money("total_amount").alias("total"))
    return tickets.join(sums, "transaction_id", "left").withColumn("delta", F.col("total") - F.col("items_total"))


def dq_amount_mismatch(tables: Tables, tolerance: float = 0.01) -> DataFrame:
    delta = F.col("delta")
    wrong = F.abs(delta) > F.lit(tolerance).cast("decimal(18,4)")
    found = ticket_deltas(tables).agg(
        F.count_if(wrong).alias("transacciones_con_diferencia"),
        F.max(F.when(wrong, F.abs(delta))).alias("diferencia_maxima"),
        F.count_if(wrong & (delta < 0)).alias("negative"),
        F.count("*").alias("total"),
    )
    return found.select(
        "transacciones_con_diferencia", "total",
        (ratio("transacciones_con_diferencia", "total") * 100).alias("pct"),
        "diferencia_maxima",
        ratio("negative", "transacciones_con_diferencia").alias("proporcion_negativa"),
    )


def dq_nonpositive_total(tables: Tables) -> DataFrame:
    return tables["transactions"].agg(F.count_if(F.col("total_amount") <= 0).alias("transacciones_no_positivas"))


def dq_zero_price_no_promo(tables: Tables) -> DataFrame:
    free = (F.col("unit_price") == 0) & ~F.col("was_on_promo")
    return tables["transaction_items"].agg(F.count_if(free).alias("items_precio_cero"))


# ---------------------------------------------------------------- keys
def dq_duplicate_keys(table: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows beyond the first of each key.  Grouping by the key combines copies on the map side."""
    copies = table.groupBy(*keys).agg(F.count("*").alias("n"))
    return copies.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicados"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )


def dq_hot_tickets(tables: Tables, lines: int = 1000) -> DataFrame:
    """Tickets with at least ``lines`` item lines: a data error, or a key to keep out of a
    bucketed layout."""
    sizes = tables["transaction_items"].groupBy("transaction_id").agg(F.count("*").alias("lineas"))
    return sizes.filter(F.col("lineas") >= lines)


def _orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key the dimension lacks.  Keys are counted first, so the anti join sees each
    distinct key once; a NULL key is an orphan."""
    per_key = fact.groupBy(key).agg(F.count("*").alias("n"))
    lost = per_key.join(dimension.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("huerfanos"))


def dq_orphan_store(tables: Tables) -> DataFrame:
    return _orphans(tables["transactions"], tables["stores"], "store_id")


def dq_orphan_item(tables: Tables) -> DataFrame:
    return _orphans(tables["transaction_items"], tables["products"], "item_id")


def dq_orphan_vendor_list(tables: Tables) -> DataFrame:
    lost = tables["products"].join(tables["vendors"].select("vendor_id"), "vendor_id", "left_anti")
    return lost.select("item_id", "item_name", "vendor_id", "category").orderBy("item_id")


def dq_orphan_vendor_count(tables: Tables) -> DataFrame:
    lost = tables["products"].join(tables["vendors"].select("vendor_id"), "vendor_id", "left_anti")
    return lost.agg(F.count("*").alias("productos_con_vendor_inexistente"))


def dq_multi_variant_stores(tables: Tables) -> DataFrame:
    return multi_variant_stores(tables)


# ---------------------------------------------------------------- dates
def dq_store_missing_days(
    tables: Tables, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """Days without any ticket per store inside the common date range: how many, in how many runs,
    and the longest run (the earliest of equals).

    Runs are read off the gaps around each selling day, so no calendar is built."""
    tx = tables["transactions"]
    first = tx.agg(F.min("transaction_date")).scalar() if start is None else F.lit(start).cast("date")
    last = tx.agg(F.max("transaction_date")).scalar() if end is None else F.lit(end).cast("date")
    days = tx.filter(F.col("transaction_date").between(first, last)).select("store_id", "transaction_date").distinct()
    ordered = Window.partitionBy("store_id").orderBy("transaction_date")
    selling = days.select(
        "store_id", "transaction_date",
        F.row_number().over(ordered).alias("place"),
        F.lead("transaction_date").over(ordered).alias("next_date"),
    )
    before_first = F.when(
        F.col("place") == 1,
        F.struct(first.alias("gap_start"), F.date_sub("transaction_date", 1).alias("gap_end")),
    )
    after = F.struct(
        F.date_add("transaction_date", 1).alias("gap_start"),
        F.coalesce(F.date_sub("next_date", 1), last).alias("gap_end"),
    )
    runs = (
        selling.select("store_id", F.inline(F.array_compact(F.array(before_first, after))))
        .withColumn("days", F.datediff("gap_end", "gap_start") + 1)
        .filter(F.col("days") > 0)
    )
    # Longest first; of equal runs the one that starts earliest.
    rank = F.struct(F.col("days"), -F.unix_date("gap_start"))
    return runs.groupBy("store_id").agg(
        F.sum("days").alias("missing_days"),
        F.count("*").alias("gap_runs"),
        F.max_by("gap_start", rank).alias("max_gap_start"),
        F.max_by("gap_end", rank).alias("max_gap_end"),
        F.max("days").cast("long").alias("max_gap_days"),
    )


def dq_before_opening(tables: Tables) -> DataFrame:
    """Tickets dated before their store opened, reduced to (store, day) before the join."""
    per_day = tables["transactions"].groupBy("store_id", "transaction_date").agg(F.count("*").alias("n"))
    early = per_day.join(tables["stores"].select("store_id", "opening_date"), "store_id").filter(
        F.col("transaction_date") < F.col("opening_date")
    )
    return early.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("transacciones"),
        F.count_distinct("store_id").alias("tiendas"),
        F.min("transaction_date").alias("fecha_minima"),
        F.max("transaction_date").alias("fecha_maxima"),
    )


def dq_profile(tables: Tables) -> DataFrame:
    """Observed period and table sizes on one row."""
    sizes = [tables[t].agg(F.count("*")).scalar().alias(t) for t in TABLE_NAMES if t != "transactions"]
    return tables["transactions"].agg(
        F.min("transaction_date").alias("desde"),
        F.max("transaction_date").alias("hasta"),
        F.count("*").alias("transactions"),
    ).select("*", *sizes)


# ---------------------------------------------------------------- findings
def _counted(df: DataFrame, checks: dict[tuple[str, ...], Column]) -> DataFrame:
    """``(name, failed, total)`` rows for many conditions from one scan of ``df``."""
    counts = [F.count_if(condition).alias(f"c{i}") for i, condition in enumerate(checks.values())]
    rows = [
        F.struct(F.array(*map(F.lit, name)).alias("name"), F.col(f"c{i}").alias("failed"))
        for i, name in enumerate(checks)
    ]
    return df.agg(F.count("*").alias("total"), *counts).select("total", F.inline(F.array(*rows)))


def _as_findings(row: DataFrame, *checks: tuple) -> DataFrame:
    """Turn one row of counts into ``(dimension, check, failed, total, pct, detail)`` rows."""
    structs = [
        F.struct(
            F.lit(dimension).alias("dimension"), F.lit(check).alias("check"),
            _count(failed).alias("failed"), _count(total).alias("total"),
            (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
        )
        for dimension, check, failed, total, detail in checks
    ]
    return row.select(F.inline(F.array(*structs))).select(
        "dimension", "check", "failed", "total", (ratio("failed", "total") * 100).alias("pct"), "detail"
    )


def _count(value: str | Column) -> Column:
    return F.coalesce((F.col(value) if isinstance(value, str) else value).cast("long"), F.lit(0))


def _ticket_findings(tables: Tables) -> DataFrame:
    """Every ticket check that a (store, day) profile can answer, from one scan of the tickets."""
    tx = tables["transactions"]
    customer, card = F.col("customer_id"), F.col("loyalty_card")
    first, last = tx.agg(F.min("transaction_date")).scalar(), tx.agg(F.max("transaction_date")).scalar()
    profile = tx.groupBy("store_id", "transaction_date").agg(
        F.count("*").alias("n"),
        F.count_if(customer.isNull()).alias("no_customer"),
        F.count_if(customer.isNull() & card).alias("card_only"),
        F.count_if(customer.isNotNull() & ~card).alias("no_card"),
        F.count_if(F.col("total_amount") <= 0).alias("nonpositive"),
    )
    ordered = Window.partitionBy("store_id").orderBy("transaction_date")
    day = F.col("transaction_date")
    before = F.datediff(day, F.coalesce(F.date_add(F.lag(day).over(ordered), 1), first))
    after = F.when(F.lead(day).over(ordered).isNull(), F.datediff(last, day)).otherwise(0)
    silence = profile.withColumns({"before": before, "after": after}).withColumn("silent", F.greatest("before", "after"))
    stores = tables["stores"].select("store_id", "opening_date", F.lit(True).alias("known"))
    early = day < F.col("opening_date")
    row = silence.join(stores, "store_id", "left").agg(
        *[F.sum(c).alias(c) for c in ("n", "no_customer", "card_only", "no_card", "nonpositive")],
        F.sum(F.when(F.col("known").isNull(), F.col("n"))).alias("no_store"),
        F.sum(F.when(early, F.col("n"))).alias("early"),
        F.min(F.when(early, day)).alias("early_from"),
        F.max(F.when(early, day)).alias("early_to"),
        F.count_distinct(F.when(F.col("silent") > 0, F.col("store_id"))).alias("silent_stores"),
        F.max(F.when(F.col("silent") > 0, F.col("silent"))).alias("longest"),
    )
    n_stores = tables["stores"].agg(F.count("*")).scalar()
    window = F.concat_ws("..", F.col("early_from").cast("string"), F.col("early_to").cast("string"))
    return _as_findings(
        row,
        ("Completitud", "transacciones_sin_cliente", "no_customer", "n", None),
        ("Consistencia", "tarjeta_sin_cliente", "card_only", "n", None),
        ("Consistencia", "cliente_sin_tarjeta", "no_card", "n", None),
        ("Validez", "total_no_positivo", "nonpositive", "n", None),
        ("Integridad referencial", "store_id_invalido", "no_store", "n", None),
        ("Frescura", "tiendas_con_dias_sin_venta", "silent_stores", n_stores, F.col("longest")),
        ("Integridad temporal", "venta_antes_de_apertura", "early", "n", window),
    )


def _line_findings(tables: Tables) -> DataFrame:
    """Line checks from one scan, reduced to items before the product join."""
    free = (F.col("unit_price") == 0) & ~F.col("was_on_promo")
    per_item = tables["transaction_items"].groupBy("item_id").agg(
        F.count("*").alias("n"), F.count_if(free).alias("free")
    )
    known = tables["products"].select("item_id", F.lit(True).alias("known"))
    row = per_item.join(known, "item_id", "left").agg(
        F.sum("n").alias("n"), F.sum("free").alias("free"),
        F.sum(F.when(F.col("known").isNull(), F.col("n"))).alias("no_item"),
    )
    return _as_findings(
        row,
        ("Validez", "precio_cero_sin_promocion", "free", "n", None),
        ("Integridad referencial", "item_id_invalido", "no_item", "n", None),
    )


def dq_findings(tables: Tables) -> DataFrame:
    """All checks as one long table; checks that share an input share its scan."""
    largest = F.col("diferencia_maxima").cast("decimal(18,2)")
    n_products = tables["products"].agg(F.count("*")).scalar()
    n_stores = tables["stores"].agg(F.count("*")).scalar()
    return union_all(
        [
            _ticket_findings(tables),
            _line_findings(tables),
            _as_findings(
                dq_amount_mismatch(tables),
                ("Consistencia", "total_distinto_de_items", "transacciones_con_diferencia", "total", largest),
            ),
            _as_findings(
                dq_duplicate_keys(tables["transactions"], ("transaction_id",)),
                ("Unicidad", "transaction_id_duplicado", "duplicados", "total", None),
            ),
            _as_findings(
                dq_orphan_vendor_count(tables),
                ("Integridad referencial", "producto_sin_vendor", "productos_con_vendor_inexistente", n_products, None),
            ),
            _as_findings(
                multi_variant_stores(tables).agg(F.count("*").alias("n")),
                ("Prueba A/B", "tienda_en_dos_variantes", "n", n_stores, None),
            ),
        ]
    )


# ---------------------------------------------------------------- rules behind the KPIs
def weekly_ticket_drops(tables: Tables, drop: float = 0.30, weeks: int = 4) -> DataFrame:
    """Store-weeks whose ticket count falls more than ``drop`` below the mean of the preceding
    ``weeks`` selling weeks."""
    weekly = tables["transactions"].groupBy("store_id", week_start("transaction_date").alias("week_start")).agg(
        F.count("*").alias("tx")
    )
    earlier = Window.partitionBy("store_id").orderBy("week_start").rowsBetween(-weeks, -1)
    mean = ratio(F.sum("tx").over(earlier), F.count("tx").over(earlier))
    return weekly.withColumn("media_previa", mean).withColumn(
        "caida", F.coalesce(F.col("tx") < F.col("media_previa") * (1 - drop), F.lit(False))
    )


def dq_kpi_rules(
    tables: Tables, horizon: DateLike | None = None, active_days: int = 180, drop: float = 0.30,
    first_months: DataFrame | None = None, gaps: DataFrame | None = None,
) -> DataFrame:
    """Rules that tell a broken KPI input from a bad week: (rule, failed, total).

    ``first_months`` is the stored first purchase month (customer_id, mes_primera_compra).  Purchases
    before it show that it is out of date, and rows without a customer belong to no cohort; without it,
    cohorts are computed from the tickets themselves, and the rule can only confirm them.  ``gaps`` are
    stored stock gaps (store_id, item_id, fecha_inicio_ausencia): an item without a sale before its
    gap was not there to be missed."""
    last = horizon_or_last(tables, horizon)
    tx, products, stores = tables["transactions"], tables["products"], tables["stores"]

    def rules(df: DataFrame, **checks: Column) -> DataFrame:
        counted = _counted(df, {(name,): condition for name, condition in checks.items()})
        return counted.select(F.col("name")[0].alias("rule"), "failed", "total")

    item_last_sale = (
        tables["transaction_items"]
        .select("transaction_id", "item_id")
        .join(completed(tables).select("transaction_id", "transaction_date"), "transaction_id")
        .groupBy("item_id")
        .agg(F.max("transaction_date").alias("last_day"))
    )
    catalogue = products.select("item_id").join(item_last_sale, "item_id", "left")
    never_or_old = F.col("last_day").isNull() | (F.datediff(last, F.col("last_day")) > active_days)
    vendor_known = products.join(
        tables["vendors"].select("vendor_id", F.lit(True).alias("known")), "vendor_id", "left"
    )
    stored = []
    if gaps is not None:
        first_sales = completed_lines(tables).groupBy("store_id", "item_id").agg(F.min("transaction_date").alias("first_day"))
        begun = gaps.select("store_id", "item_id", "fecha_inicio_ausencia").join(first_sales, ["store_id", "item_id"], "left")
        unsold = F.col("first_day").isNull() | (F.col("first_day") >= F.col("fecha_inicio_ausencia"))
        stored.append(rules(begun, ausencia_sin_ventas_previas=unsold))
    cohorts = cohort_activity(tables, months=None)
    if first_months is not None:
        stored.append(rules(first_months, cohorte_sin_cliente=F.col("customer_id").isNull()))
        relative = month_index_diff(F.col("mes_compra"), F.col("mes_primera_compra"))
        cohorts = loyalty_months(tables).join(first_months, "customer_id").withColumn("mes_relativo", relative)
    return union_all(
        [
            rules(stores, superficie_nula_o_cero=F.col("size_sqm").isNull() | (F.col("size_sqm") <= 0)),
            rules(
                tx,
                venta_negativa_sin_devolucion=(F.col("total_amount") < 0) & (F.col("status") != RETURNED),
                ticket_no_positivo=F.col("total_amount") <= 0,
                tarjeta_sin_cliente=F.col("customer_id").isNull() & F.col("loyalty_card"),
            ),
            rules(weekly_ticket_drops(tables, drop), caida_de_transacciones=F.col("caida")),
            rules(cohorts, mes_relativo_negativo=F.col("mes_relativo") < 0),
            rules(
                vendor_known,
                costo_nulo_o_cero=F.col("cost").isNull() | (F.col("cost") <= 0),
                vendor_inexistente=F.col("known").isNull(),
            ),
            rules(catalogue, item_sin_ventas_recientes=never_or_old, item_sin_historia=F.col("last_day").isNull()),
            *stored,
        ]
    )
