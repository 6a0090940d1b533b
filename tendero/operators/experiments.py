"""A/B trial analysis: clean assignment, period metrics, balance checks and Welch tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendero.functions import money_sum, ratio, t_critical, t_two_sided_p, transaction_count
from tendero.operators.base import DateLike, as_date, between_dates, completed
from tendero.schemas import CONTROL, TREATMENT, Tables


def multi_variant_stores(tables: Tables) -> DataFrame:
    """Stores assigned to more than one variant, with the sorted list of variants."""
    return (
        tables["store_promotions"]
        .groupBy("store_id")
        .agg(
            F.count_distinct("variant").alias("variantes_distintas"),
            F.array_join(F.array_sort(F.collect_set("variant")), ", ").alias("variantes_detectadas"),
        )
        .filter(F.col("variantes_distintas") > 1)
    )


def ab_clean_assignment(tables: Tables) -> DataFrame:
    """One variant per store; ambiguous stores are left out of the trial."""
    per_store = tables["store_promotions"].groupBy("store_id").agg(
        F.count_distinct("variant").alias("variants"), F.min("variant").alias("variant")
    )
    return per_store.filter(F.col("variants") == 1).drop("variants")


def ab_period_metrics(
    tables: Tables, start: DateLike, end: DateLike, weeks: int = 6, name: str = "test", unique_ids: bool = False
) -> DataFrame:
    """Weekly sales, weekly tickets and average ticket of each trial store in a window."""
    per_store = (
        between_dates(completed(tables), start, end)
        .groupBy("store_id")
        .agg(money_sum("total_amount").alias("gmv"), transaction_count(unique_ids).alias("tx"))
    )
    return per_store.join(ab_clean_assignment(tables), "store_id").select(
        "store_id", "variant",
        ratio("gmv", F.lit(weeks)).alias(f"{name}_weekly_gmv"),
        ratio("tx", F.lit(weeks)).alias(f"{name}_weekly_tx"),
        ratio("gmv", "tx").alias(f"{name}_ticket"),
    )


def pre_period(start: DateLike, weeks: int = 6) -> tuple[Column, Column]:
    """The window of the same length that ends the day before ``start``."""
    first = as_date(start)
    return F.date_sub(first, weeks * 7), F.date_sub(first, 1)


def ab_wide(tables: Tables, start: DateLike, end: DateLike, weeks: int = 6) -> DataFrame:
    """Before and during the trial side by side, for stores with sales in both."""
    before = ab_period_metrics(tables, *pre_period(start, weeks), weeks, "pre")
    during = ab_period_metrics(tables, start, end, weeks, "test")
    return before.join(during.drop("variant"), "store_id").withColumns(
        {
            "gmv_change": F.col("test_weekly_gmv") - F.col("pre_weekly_gmv"),
            "tx_change": F.col("test_weekly_tx") - F.col("pre_weekly_tx"),
            "ticket_change": F.col("test_ticket") - F.col("pre_ticket"),
        }
    )


def ab_format_counts(tables: Tables, formats: tuple[str, ...]) -> DataFrame:
    """Stores by variant, one column per format; no store counts as zero."""
    placed = ab_clean_assignment(tables).join(tables["stores"].select("store_id", "format"), "store_id")
    return placed.groupBy("variant").agg(*[F.count_if(F.col("format") == f).alias(f) for f in formats])


def ab_size_summary(tables: Tables) -> DataFrame:
    placed = ab_clean_assignment(tables).join(tables["stores"].select("store_id", "size_sqm"), "store_id")
    size = F.col("size_sqm")
    return placed.groupBy("variant").agg(
        F.count(size).alias("count"), F.avg(size).alias("mean"), F.median(size).alias("median"),
        F.min(size).alias("min"), F.max(size).alias("max"),
    )


def ab_summary(metrics: DataFrame, name: str) -> DataFrame:
    return metrics.groupBy("variant").agg(
        F.count_distinct("store_id").alias("n"),
        F.avg(f"{name}_weekly_gmv").alias("avg_weekly_gmv"),
        F.avg(f"{name}_weekly_tx").alias("avg_weekly_tx"),
        F.avg(f"{name}_ticket").alias("avg_ticket"),
    )


def welch_stats(
    df: DataFrame,
    metrics: tuple[str, ...],
    group: str = "variant",
    control: str = CONTROL,
    treatment: str = TREATMENT,
    segments: tuple[str, ...] = (),
) -> DataFrame:
    """Welch statistics of every metric (and segment) in one aggregation.

    Metrics are unpivoted, so many tests are one job; only counts, means and variances shuffle."""
    long = df.unpivot([group, *segments], list(metrics), "metric", "value")

    def side(variant: str) -> Column:
        return F.when(F.col(group) == variant, F.col("value"))

    moments = long.groupBy("metric", *segments).agg(
        F.count(side(control)).alias("n_control"),
        F.count(side(treatment)).alias("n_treatment"),
        F.avg(side(control)).alias("control_mean"),
        F.avg(side(treatment)).alias("treatment_mean"),
        F.var_samp(side(control)).alias("v_c"),
        F.var_samp(side(treatment)).alias("v_t"),
    )
    e_c, e_t = ratio("v_c", "n_control"), ratio("v_t", "n_treatment")
    spread = moments.withColumns({"e_c": e_c, "e_t": e_t}).withColumns(
        {
            "diff": F.col("treatment_mean") - F.col("control_mean"),
            "se": F.sqrt(F.col("e_c") + F.col("e_t")),
        }
    )
    pooled = F.col("e_c") + F.col("e_t")
    weights = ratio(F.col("e_c") * F.col("e_c"), F.col("n_control") - 1) + ratio(
        F.col("e_t") * F.col("e_t"), F.col("n_treatment") - 1
    )
    return spread.select(
        "metric", *segments, "n_control", "n_treatment", "control_mean", "treatment_mean", "diff",
        (ratio("diff", "control_mean") * 100).alias("lift_pct"),
        "se",
        ratio("diff", "se").alias("t"),
        ratio(pooled * pooled, weights).alias("df"),
    )


def welch_test(
    df: DataFrame,
    metrics: tuple[str, ...],
    group: str = "variant",
    control: str = CONTROL,
    treatment: str = TREATMENT,
    segments: tuple[str, ...] = (),
    alpha: float = 0.05,
) -> DataFrame:
    """Welch statistics with the two-sided p value and the confidence interval of the difference."""
    stats = welch_stats(df, metrics, group, control, treatment, segments)
    scored = stats.withColumns(
        {"p_value": t_two_sided_p("t", "df"), "half": t_critical("df", F.lit(alpha)) * F.col("se")}
    )
    return scored.withColumns(
        {"ci_low": F.col("diff") - F.col("half"), "ci_high": F.col("diff") + F.col("half")}
    ).drop("se", "half")


def ab_did(tables: Tables, start: DateLike, end: DateLike, weeks: int = 6, alpha: float = 0.05) -> DataFrame:
    """Difference in differences: the Welch test on each store's own change."""
    changes = ("gmv_change", "tx_change", "ticket_change")
    return welch_test(ab_wide(tables, start, end, weeks), changes, alpha=alpha)
