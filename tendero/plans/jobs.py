"""The mart batch: six result tables, and the report exports."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tendero.functions import ratio
from tendero.operators import cohorts, mix, sales, stockgaps, timeseries
from tendero.operators.base import TICKET_LINES, ticket_lines, union_all
from tendero.schemas import Tables
from tendero.sources.sinks import export, save


@dataclass(frozen=True)
class MartPeriods:
    """Dates the six marts depend on."""

    current_start: str
    current_end: str
    quarter_start: str
    quarter_end: str
    horizon: str
    gap_grain: tuple[str, ...] = stockgaps.STORE_ITEM


def mart_plans(tables: Tables, periods: MartPeriods) -> dict[str, Callable[[], DataFrame]]:
    p = periods
    return {
        "ventas_comparables": lambda: sales.comp_sales_store(tables, p.current_start, p.current_end),
        "productividad_tienda": lambda: sales.store_productivity(tables, p.quarter_start, p.quarter_end),
        "cohortes_lealtad": lambda: cohorts.cohort_retention(tables),
        "retorno_margen": lambda: mix.vendor_margin_return(tables),
        "quiebres_stock": lambda: stockgaps.stock_gaps(tables, p.gap_grain, p.horizon),
        "promociones": lambda: mix.promo_impact(tables),
    }


def with_shared_lines(tables: Tables, out: str) -> Tables:
    """The tables with the join of lines and tickets, which half the marts begin with, stored below ``out``."""
    stored = save(ticket_lines(tables), path=f"{out}/_ticket_lines")
    return ChainMap({TICKET_LINES: stored}, tables)


def run_marts(
    tables: Tables, periods: MartPeriods, out: str, counted: dict[str, int] | None = None
) -> dict[str, DataFrame]:
    """Write the six marts below ``out`` and return them read back.  Lines and tickets are joined once.
    ``counted`` receives the rows of each mart, counted as they are written."""
    marts = {}
    for name, plan in mart_plans(with_shared_lines(tables, out), periods).items():
        seen = Observation(name)
        marts[name] = save(plan().observe(seen, F.count(F.lit(1)).alias("filas")), path=f"{out}/{name}")
        if counted is not None:
            counted[name] = seen.get["filas"]
    return marts


def mart_counts(marts: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            frame.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas")
            for name, frame in marts.items()
        ]
    )


def export_reports(tables: Tables, periods: MartPeriods, out: str) -> list[str]:
    """The ten report files as CSV folders."""
    p = periods
    comparable = sales.comp_sales_store(tables, p.current_start, p.current_end)
    activity = cohorts.cohort_activity(tables)
    gaps = stockgaps.stock_gaps(tables, p.gap_grain, p.horizon)

    def pivot(value: str) -> DataFrame:
        return activity.groupBy("mes_cohorte").pivot("mes_relativo", list(cohorts.MONTHS)).agg(F.max(value))

    reports = {
        "comp_sales_store": comparable,
        "comp_sales_country_format": sales.comp_sales_country_format(comparable),
        "productivity_store": sales.store_productivity(tables, p.quarter_start, p.quarter_end),
        "cohort_retention": pivot("tasa_retencion"),
        "cohort_ticket": pivot("ticket_promedio"),
        "vendor_margin": mix.vendor_margin_return(tables),
        "promo_basket_category": mix.promo_impact_long(tables),
        "weekly_sales_format": timeseries.weekly_change(timeseries.weekly_sales(tables, p.horizon)),
        "pareto_category_format": mix.pareto(tables),
        "stock_gaps_top": stockgaps.top_gaps(gaps, 1000, grain=p.gap_grain),
    }
    return [export(frame, f"{out}/{name}", "csv") for name, frame in reports.items()]


# ---------------------------------------------------------------- dashboard payload
def dashboard_daily(tables: Tables) -> DataFrame:
    return sales.store_day(tables).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def dashboard_retention(tables: Tables) -> DataFrame:
    """Cohort label and retention percentages with one decimal."""
    retention = cohorts.cohort_retention(tables)
    return retention.select(
        F.date_format("mes_cohorte", "yyyy-MM").alias("cohort"),
        *[F.round(F.col(f"retencion_mes_{m}") * 100, 1).alias(f"m{m}") for m in cohorts.MONTHS],
    )


def dashboard_stock(gaps: DataFrame, n: int = 250, grain: tuple[str, ...] = stockgaps.STORE_ITEM) -> DataFrame:
    names = ["store_id", "store_name", "country", "format", "region", "item_id", "item_name", "category"]
    wanted = [c for c in names if c in gaps.columns]
    return stockgaps.top_gaps(gaps, n, active_only=True, grain=grain).select(
        *wanted, "dias_sin_venta", "venta_estimada_perdida"
    )


def export_dashboard(tables: Tables, periods: MartPeriods, out: str) -> list[str]:
    gaps = stockgaps.stock_gaps(tables, periods.gap_grain, periods.horizon)
    payload = {
        "daily": dashboard_daily(tables),
        "retention": dashboard_retention(tables),
        "stock": dashboard_stock(gaps, grain=periods.gap_grain),
    }
    return [export(frame, f"{out}/{name}", "json") for name, frame in payload.items()]


def comparable_sales_card(comparable: DataFrame) -> DataFrame:
    """The headline card: both periods of the comparable stores only, not all sales."""
    total = comparable.agg(F.sum(sales.CURRENT).alias("c"), F.sum(sales.PREVIOUS).alias("p"))
    return total.select((F.col("c") + F.col("p")).alias("ventas_comparables"), (ratio("c", "p") - 1).alias("crecimiento"))
