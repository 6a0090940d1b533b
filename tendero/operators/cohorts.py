"""Loyalty cohorts.

Tickets collapse to (customer, month) first.  From there a window over a customer's few months
finds the cohort without joining the customers back, active customers are plain row counts
instead of distinct counts, and the cohort size is its own month 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tendero.functions import money_sum, month_index_diff, ratio
from tendero.operators.base import DateLike, as_date, completed
from tendero.schemas import TREND_DOWN, TREND_UNKNOWN, TREND_UP, Tables

MONTHS = (0, 1, 2, 3, 6)


def loyalty_months(tables: Tables) -> DataFrame:
    """(customer, month): tickets and amount of identified loyalty purchases."""
    return (
        completed(tables)
        .filter(F.col("loyalty_card") & F.col("customer_id").isNotNull())
        .groupBy("customer_id", F.trunc("transaction_date", "MM").alias("mes_compra"))
        .agg(money_sum("total_amount").alias("amount"), F.count("total_amount").alias("tickets"))
    )


def customer_first_month(tables: Tables) -> DataFrame:
    return (
        completed(tables)
        .filter(F.col("loyalty_card") & F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.trunc(F.min("transaction_date"), "MM").alias("mes_primera_compra"))
    )


def cohort_activity(tables: Tables, months: tuple[int, ...] | None = MONTHS) -> DataFrame:
    """Active customers, average ticket and retention per cohort and relative month."""
    of_customer = Window.partitionBy("customer_id")
    months_of_life = (
        loyalty_months(tables)
        .withColumn("mes_cohorte", F.min("mes_compra").over(of_customer))
        .withColumn("mes_relativo", month_index_diff(F.col("mes_compra"), F.col("mes_cohorte")).cast("long"))
    )
    active = months_of_life.groupBy("mes_cohorte", "mes_relativo").agg(
        F.count("*").alias("clientes_activos"),
        ratio(F.sum("amount"), F.sum("tickets")).alias("ticket_promedio"),
    )
    of_cohort = Window.partitionBy("mes_cohorte")
    size = F.max(F.when(F.col("mes_relativo") == 0, F.col("clientes_activos"))).over(of_cohort)
    rows = active.withColumn("clientes_cohorte", size).withColumn(
        "tasa_retencion", ratio("clientes_activos", "clientes_cohorte")
    )
    return rows if months is None else rows.filter(F.col("mes_relativo").isin(*months))


def cohort_retention(
    tables: Tables, months: tuple[int, ...] = MONTHS, trend: tuple[int, int] = (0, 6)
) -> DataFrame:
    """Cohorts as rows, months as columns, and whether the ticket grew between two months."""
    first, last = trend
    wanted = sorted({*months, first, last})

    def at(month: int, value: str):
        return F.max(F.when(F.col("mes_relativo") == month, F.col(value)))

    start, end = at(first, "ticket_promedio"), at(last, "ticket_promedio")
    return cohort_activity(tables, tuple(wanted)).groupBy("mes_cohorte").agg(
        F.max("clientes_cohorte").alias("clientes_cohorte"),
        *[at(m, "tasa_retencion").alias(f"retencion_mes_{m}") for m in months],
        *[at(m, "ticket_promedio").alias(f"ticket_promedio_mes_{m}") for m in months],
        F.when(end > start, TREND_UP)
        .when(end < start, TREND_DOWN)
        .otherwise(TREND_UNKNOWN)
        .alias(f"tendencia_ticket_mes_{first}_a_mes_{last}"),
    )


def cohort_group_compare(
    tables: Tables, early_end: DateLike, recent_start: DateLike, recent_end: DateLike, month: int = 1
) -> DataFrame:
    """Unweighted mean of one month's retention in early against recent cohorts."""
    cohort = F.col("mes_cohorte")
    rate = F.col("tasa_retencion")
    return cohort_activity(tables, (month,)).agg(
        F.avg(F.when(cohort <= as_date(early_end), rate)).alias("retencion_tempranas"),
        F.avg(F.when(cohort.between(as_date(recent_start), as_date(recent_end)), rate)).alias("retencion_recientes"),
    )
