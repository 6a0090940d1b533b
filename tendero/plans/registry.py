"""Every operator as a named query over the benchmark tables.

A query takes ``(spark, directory)`` and returns a DataFrame over the whole tables.  Results are
presented in portable types (decimals as doubles, timestamps as text) so that another SQL engine
can be compared with them; columns that depend on floating-point summation order are rounded.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendero.operators import base, cohorts, experiments, incremental, kpis, marts, mix, quality, rollups, sales, series, stockgaps
from tendero.functions import net_amount
from tendero.operators import timeseries as ts
from tendero.plans import jobs
from tendero.schemas import RETURNED, Tables
from tendero.session import work_folder
from tendero.sources import benchmark, files, layout, sinks, versions
from tendero.streaming import feed as streams
from tendero.streaming import freshness
from tendero.streaming.alerts import live_alerts, run_alerts

# Parameters that fit the benchmark data (orders run from 1995-01-01 to 2001-08-01).
CURRENT = ("2001-01-01", "2001-06-30")
QUARTER = ("2001-04-01", "2001-06-30")
HORIZON = "2001-08-01"
FIRST_DAY = "1995-01-01"
TRIAL = (benchmark.TRIAL_START, benchmark.TRIAL_END)
LEDGER_TASK_ROWS = 500_000
CATEGORY_GRAIN = ("store_id", "category")
FORMATS = ("DESCUENTO", "EXPRESS", "HIPERMERCADO", "SUPERMERCADO")
SALT = "benchmark-salt"
LOAD_CUT = "2001-01-01"
PERIODS = jobs.MartPeriods(*CURRENT, *QUARTER, HORIZON, CATEGORY_GRAIN)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def portable(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    digits = digits or {}
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        if field.name in digits:
            column = F.round(column, digits[field.name])
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, **digits: int):
    """Register a plan over the retail tables."""

    def register(plan: Callable[[Tables], DataFrame]):
        _QUERIES[name] = lambda spark, directory: portable(plan(benchmark.retail_tables(spark, directory)), digits)
        return plan

    return register


def session_query(name: str, **digits: int):
    """Register a plan that also needs the session and the folder (storage, streams, SQL text)."""

    def register(plan: Query):
        _QUERIES[name] = lambda spark, directory: portable(plan(spark, directory), digits)
        return plan

    return register


# ---------------------------------------------------------------- sources, sinks, SQL
@session_query("load_csv")
def _load_csv(spark: SparkSession, directory: str) -> DataFrame:
    """One half in the table's order; the other with the columns turned round, one more, and line breaks."""
    path = work_folder(spark, "load-csv")
    source = benchmark.retail_tables(spark, directory)["transactions"]
    text = source.withColumn("loyalty_card", F.when(F.col("loyalty_card"), "True").otherwise("False"))
    even = F.col("transaction_id") % 2 == 0
    quoted = F.concat(F.lit('a "quoted", '), F.col("payment_method"), F.lit("\t"))
    sinks.export(text.filter(even).withColumn("payment_method", quoted), f"{path}/even", "csv")
    broken = F.concat(F.lit('a "quoted",\n'), F.col("payment_method"))
    turned = text.filter(~even).withColumn("payment_method", broken).withColumn("note", F.lit("not ours"))
    sinks.export(turned.select(*reversed(turned.columns)), f"{path}/odd", "csv")
    return files.read_csv_table(spark, f"{path}/*", "transactions")


def _with_bad_lines(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """A file in which one amount in seventeen is no number."""
    path = work_folder(spark, "load-csv-bad")
    source = benchmark.retail_tables(spark, directory)["transactions"]
    amount = F.when(F.col("transaction_id") % 17 == 0, "12x.5").otherwise(F.col("total_amount").cast("string"))
    sinks.export(source.withColumn("total_amount", amount), path, "csv")
    return files.split_bad_rows(spark, path, "transactions")


@session_query("load_csv_bad_rows")
def _bad_rows(spark: SparkSession, directory: str) -> DataFrame:
    good, bad = _with_bad_lines(spark, directory)
    return good.select("transaction_id", F.lit("").alias("failed")).unionAll(
        bad.select(F.trim("transaction_id"), F.concat_ws(",", files.FAILED))
    )


@query("load_csv_dates")
def _signed(t: Tables) -> DataFrame:
    return base.signed_transactions(t).select("transaction_id", "transaction_date", "status", "sign", "net_gmv")


query("table_counts")(base.table_counts)
query("load_validation")(base.load_validation)
query("net_transactions")(base.net_transactions)
query("item_sales")(base.item_sales)
query("sales_enriched")(base.sales_enriched)


@session_query("save_table")
def _save_table(spark: SparkSession, directory: str) -> DataFrame:
    daily = sales.store_day(benchmark.retail_tables(spark, directory))
    monthly = daily.withColumn("month", F.date_format("date", "yyyyMM"))
    stored = sinks.save(monthly, path=work_folder(spark, "store-day"), partition_by=("month",))
    return stored.select(*daily.columns)


@session_query("run_marts")
def _run_marts(spark: SparkSession, directory: str) -> DataFrame:
    tables = benchmark.retail_tables(spark, directory)
    counted: dict[str, int] = {}
    jobs.run_marts(tables, PERIODS, work_folder(spark, "marts"), counted)
    return spark.createDataFrame(list(counted.items()), "tabla string, filas long")


@session_query("preview")
def _preview(spark: SparkSession, directory: str) -> DataFrame:
    sinks.register_views(benchmark.retail_tables(spark, directory))
    text = "SELECT transaction_id, store_id, ventas_netas FROM v_transacciones_ventas_netas ORDER BY transaction_id"
    return sinks.run_sql(spark, text, limit=20)


@session_query("adhoc_sql")
def _adhoc(spark: SparkSession, directory: str) -> DataFrame:
    sinks.register_views(benchmark.retail_tables(spark, directory))
    return sinks.run_sql(
        spark,
        """SELECT s.country, s.format, SUM(v.ventas_netas) AS ventas_netas, COUNT(*) AS transacciones
           FROM v_transacciones_ventas_netas v JOIN stores s USING (store_id)
           GROUP BY s.country, s.format;""",
    )


@session_query("export_csv")
def _export_csv(spark: SparkSession, directory: str) -> DataFrame:
    path = work_folder(spark, "export-csv")
    result = portable(mix.promo_impact_long(benchmark.retail_tables(spark, directory)))
    sinks.export(result, path, "csv")
    return spark.read.schema(result.schema).option("header", True).csv(path)


@session_query("export_json")
def _export_json(spark: SparkSession, directory: str) -> DataFrame:
    path = work_folder(spark, "export-json")
    result = portable(jobs.dashboard_daily(benchmark.retail_tables(spark, directory)))
    sinks.export(result, path, "json")
    return spark.read.schema(result.schema).json(path)


@session_query("export_reports")
def _export_reports(spark: SparkSession, directory: str) -> DataFrame:
    """Lines of each report file, read back."""
    paths = jobs.export_reports(benchmark.retail_tables(spark, directory), PERIODS, work_folder(spark, "reports"))
    return base.union_all(
        [
            spark.read.option("header", True).option("escape", '"').csv(path)
            .agg(F.count("*").alias("filas")).select(F.lit(path.rsplit("/", 1)[1]).alias("reporte"), "filas")
            for path in paths
        ]
    )


@session_query("stored_layout")
def _stored_layout(spark: SparkSession, directory: str) -> DataFrame:
    """Net sales by category over the bucketed tables: lines and tickets meet in place."""
    prefix = f"retail_{uuid.uuid4().hex[:8]}"
    layout.store_retail(benchmark.retail_tables(spark, directory), prefix)
    return sales.category_sales(layout.stored_retail(spark, prefix))


query("dashboard_retention")(jobs.dashboard_retention)


@query("dashboard_stock")
def _dashboard_stock(t: Tables) -> DataFrame:
    return jobs.dashboard_stock(stockgaps.stock_gaps(t, CATEGORY_GRAIN, HORIZON), grain=CATEGORY_GRAIN)


# ---------------------------------------------------------------- data quality
for _name, _plan in {
    "dq_null_customer": quality.dq_null_customer,
    "dq_loyalty_consistency": quality.dq_loyalty_consistency,
    "dq_loyalty_matrix": quality.dq_loyalty_matrix,
    "dq_amount_mismatch": quality.dq_amount_mismatch,
    "dq_nonpositive_total": quality.dq_nonpositive_total,
    "dq_zero_price_no_promo": quality.dq_zero_price_no_promo,
    "dq_orphan_store": quality.dq_orphan_store,
    "dq_orphan_item": quality.dq_orphan_item,
    "dq_orphan_vendor_count": quality.dq_orphan_vendor_count,
    "dq_orphan_vendor_list": quality.dq_orphan_vendor_list,
    "dq_store_missing_days": quality.dq_store_missing_days,
    "dq_before_opening": quality.dq_before_opening,
    "dq_multi_variant_stores": quality.dq_multi_variant_stores,
    "dq_profile": quality.dq_profile,
    "dq_findings": quality.dq_findings,
}.items():
    query(_name)(_plan)


@session_query("dq_kpi_rules")
def _kpi_rules(spark: SparkSession, directory: str) -> DataFrame:
    """Against a stored dimension and stored gaps that are partly wrong: first months that are too late or belong
    to nobody, and gaps that begin before the item's first sale."""
    t, folder = benchmark.retail_tables(spark, directory), work_folder(spark, "kpi-rules")
    customer, month = F.col("customer_id"), F.col("mes_primera_compra")
    months = cohorts.customer_first_month(t).select(
        F.when(customer % 11 != 0, customer).alias("customer_id"),
        F.when(customer % 7 == 0, F.add_months(month, 2)).otherwise(month).alias("mes_primera_compra"),
    )
    start = F.col("fecha_inicio_ausencia")
    gaps = stockgaps.stock_gaps(t, horizon=HORIZON).select(
        "store_id", "item_id", F.when(F.col("item_id") % 13 == 0, F.date_sub(start, 400)).otherwise(start).alias("fecha_inicio_ausencia")
    )
    stored = [sinks.save(frame, path=f"{folder}/{k}") for k, frame in enumerate((months, gaps))]
    return quality.dq_kpi_rules(t, HORIZON, first_months=stored[0], gaps=stored[1])


@query("dq_duplicate_keys")
def _duplicates(t: Tables) -> DataFrame:
    return quality.dq_duplicate_keys(t["transaction_items"], ("transaction_item_id",))


# ---------------------------------------------------------------- sales, mix
def _comparable(t: Tables) -> DataFrame:
    return sales.comp_sales_store(t, *CURRENT)


def _productivity(t: Tables, method: str = "linear") -> DataFrame:
    return sales.store_productivity(t, *QUARTER, method=method)


query("comp_sales_store")(_comparable)
query("comp_sales_country_format")(lambda t: sales.comp_sales_country_format(_comparable(t)))
query("comp_sales_by_format")(lambda t: sales.comp_sales_by(_comparable(t), "format"))
query("comp_sales_by_country")(lambda t: sales.comp_sales_by(_comparable(t), "country"))
query("comp_sales_levels")(lambda t: sales.comp_sales_levels(_comparable(t)))
query("comp_sales_extremes")(lambda t: sales.comp_sales_extremes(_comparable(t)))
query("comp_sales_card")(lambda t: jobs.comparable_sales_card(_comparable(t)))
query("store_productivity", percentil_25_ventas_por_metro_cuadrado=6)(_productivity)
query("store_productivity_p25_lower")(lambda t: _productivity(t, "lower"))
query("productivity_bottom_n")(lambda t: sales.productivity_bottom_n(_productivity(t, "lower"), 12))
query("low_stores_by_format")(lambda t: sales.low_stores_by_format(_productivity(t)))
query("net_sales_total")(sales.net_sales_total)
query("net_sales_by_format")(sales.net_sales_by_format)
query("net_sales_by_country_format")(sales.net_sales_by_country_format)
query("top_stores")(sales.top_stores)
query("category_sales")(sales.category_sales)
query("returns_by_format")(sales.returns_by_format)
query("stores_by_format")(sales.stores_by_format)
query("pareto")(mix.pareto)
query("pareto_top_categories")(lambda t: mix.pareto_top_categories(mix.pareto(t)))
query("pareto_top_by_format")(lambda t: mix.pareto_top_by_format(mix.pareto(t)))
query("category_share")(mix.category_share)
query("category_recommendation")(lambda t: mix.category_recommendation(t, HORIZON))
query("vendor_margin_return")(mix.vendor_margin_return)
query("vendor_margin_low")(lambda t: mix.vendor_margin_low_count(mix.vendor_margin_return(t)))
query("vendor_margin_worst")(lambda t: mix.vendor_margin_worst(mix.vendor_margin_return(t)))
query("promo_impact")(mix.promo_impact)
query("promo_impact_long")(mix.promo_impact_long)
query("promo_impact_ranked")(lambda t: mix.promo_impact_ranked(mix.promo_impact(t)))
query("store_day")(sales.store_day)
query("store_day_filtered")(
    lambda t: sales.store_day(t, country="AMERICA", format="SUPERMERCADO", start=LOAD_CUT, end=HORIZON)
)


@session_query("store_day_stored")
def _store_day_stored(spark: SparkSession, directory: str) -> DataFrame:
    path = work_folder(spark, "store-day-mart")
    mart = rollups.save_store_day(benchmark.retail_tables(spark, directory), path)
    rows = rollups.store_day_between(mart, LOAD_CUT, HORIZON, country="AMERICA", format="SUPERMERCADO")
    return rows.drop("month", "tickets_sketch", "customers_sketch")


@session_query("store_day_quarter")
def _store_day_quarter(spark: SparkSession, directory: str) -> DataFrame:
    """The second quarter of every year, as the stored date dimension has it."""
    t, folder = benchmark.retail_tables(spark, directory), work_folder(spark, "store-day-quarter")
    mart = rollups.save_store_day(t, f"{folder}/mart")
    dates = sinks.save(marts.dim_date(t), path=f"{folder}/dim_date")
    return rollups.store_day_on(mart, dates.filter("trimestre = 2")).drop("month", "tickets_sketch", "customers_sketch")


@session_query("distinct_rollup")
def _distinct_rollup(spark: SparkSession, directory: str) -> DataFrame:
    """Sales by month and format from the mart, and whether the merged sketches are within five standard errors
    of the exact counts."""
    t = benchmark.retail_tables(spark, directory)
    mart = rollups.save_store_day(t, work_folder(spark, "store-day-mart"))
    keys = ("month", "format")
    exact = (
        t["transactions"].join(t["stores"].select("store_id", "format"), "store_id")
        .groupBy(F.date_format("transaction_date", "yyyyMM").cast("int").alias("month"), "format")
        .agg(F.count_distinct("transaction_id").alias("tickets"), F.count_distinct("customer_id").alias("customers"))
    )
    close = [
        (F.abs(F.col(f"{n}_estimate") - F.col(n)) <= F.col(n) * 5 * 1.04 / 2 ** (rollups.LOG_K / 2)).alias(f"{n}_within")
        for n in rollups.SKETCHED
    ]
    return rollups.distinct_rollup(mart, *keys).join(exact, list(keys)).select(*keys, "gmv", *rollups.SKETCHED, *close)


# ---------------------------------------------------------------- cohorts
query("cohort_activity")(cohorts.cohort_activity)
query("cohort_retention")(cohorts.cohort_retention)
query("cohort_group_compare", retencion_tempranas=8, retencion_recientes=8)(
    lambda t: cohorts.cohort_group_compare(t, "1995-03-01", "1995-04-01", "1995-06-01")
)
query("customer_first_month")(cohorts.customer_first_month)


# ---------------------------------------------------------------- stock gaps
def _gaps(t: Tables) -> DataFrame:
    return stockgaps.stock_gaps(t, CATEGORY_GRAIN, HORIZON)


def _item_gaps(t: Tables) -> DataFrame:
    return stockgaps.stock_gaps(t, horizon=HORIZON)


query("daily_item_sales")(stockgaps.daily_item_sales)


@query("date_spine")
def _spine(t: Tables) -> DataFrame:
    horizon = base.as_date(HORIZON)
    return stockgaps.date_spine(stockgaps.daily_item_sales(t, CATEGORY_GRAIN), horizon, CATEGORY_GRAIN)


query("stock_gaps")(_gaps)
query("stock_gaps_item")(_item_gaps)
query("stock_gaps_calendar")(lambda t: stockgaps.stock_gaps_calendar(t, CATEGORY_GRAIN, HORIZON))
query("lost_sales_by_category")(lambda t: stockgaps.lost_sales_by_category(_item_gaps(t)))
query("lost_sales_by_vendor")(lambda t: stockgaps.lost_sales_by_vendor(_item_gaps(t)))
query("active_gaps")(lambda t: stockgaps.top_gaps(_item_gaps(t), 250, active_only=True))
query("top_gaps")(lambda t: stockgaps.top_gaps(_item_gaps(t), 1000))
query("gap_totals")(lambda t: stockgaps.gap_totals(_item_gaps(t)))

# ---------------------------------------------------------------- weekly series
query("weekly_sales")(lambda t: ts.weekly_sales(t, HORIZON))
query("weekly_change")(lambda t: ts.weekly_change(ts.weekly_sales(t, HORIZON)))
query("format_volatility", std=3, cv=8)(lambda t: ts.format_volatility(ts.weekly_sales(t, HORIZON)))
query("weekly_extremes")(lambda t: ts.weekly_extremes(ts.weekly_change(ts.weekly_sales(t, HORIZON))))

# ---------------------------------------------------------------- experiments
_SUMMARY_DIGITS = {"avg_weekly_gmv": 4, "avg_weekly_tx": 6, "avg_ticket": 4}
_WELCH_DIGITS = {"control_mean": 3, "treatment_mean": 3, "diff": 3, "lift_pct": 6, "se": 3, "t": 6, "df": 6}
_P_DIGITS = {"p_value": 7, "ci_low": 1, "ci_high": 1}
_TEST_METRICS = ("test_weekly_gmv", "test_weekly_tx", "test_ticket")


def _pre(t: Tables) -> DataFrame:
    return experiments.ab_period_metrics(t, *experiments.pre_period(TRIAL[0]), name="pre")


def _during(t: Tables) -> DataFrame:
    return experiments.ab_period_metrics(t, *TRIAL)


def _during_with_format(t: Tables) -> DataFrame:
    return _during(t).join(t["stores"].select("store_id", "format"), "store_id")


query("ab_clean_assignment")(experiments.ab_clean_assignment)
query("ab_period_metrics")(_during)
query("ab_wide")(lambda t: experiments.ab_wide(t, *TRIAL))
query("ab_format_counts")(lambda t: experiments.ab_format_counts(t, FORMATS))
query("ab_size_summary", mean=6)(experiments.ab_size_summary)
query("ab_pre_summary", **_SUMMARY_DIGITS)(lambda t: experiments.ab_summary(_pre(t), "pre"))
query("ab_test_summary", **_SUMMARY_DIGITS)(lambda t: experiments.ab_summary(_during(t), "test"))
query("welch_stats", **_WELCH_DIGITS)(lambda t: experiments.welch_stats(_during(t), _TEST_METRICS))
query("welch_stats_by_format", **_WELCH_DIGITS)(
    lambda t: experiments.welch_stats(_during_with_format(t), _TEST_METRICS, segments=("format",))
)
query("welch_test", **_WELCH_DIGITS, **_P_DIGITS)(lambda t: experiments.welch_test(_during(t), _TEST_METRICS))
query("ab_did", **_WELCH_DIGITS, **_P_DIGITS)(lambda t: experiments.ab_did(t, *TRIAL))

# ---------------------------------------------------------------- star schema
query("fact_sales_item")(lambda t: marts.fact_sales_item(t, SALT))
query("fact_transaction")(lambda t: marts.fact_transaction(t, SALT))
query("fact_store_day")(marts.fact_store_day)
query("fact_stock_gap")(lambda t: marts.fact_stock_gap(t, HORIZON))
query("fact_cohort_month")(marts.fact_cohort_month)
query("dim_date")(marts.dim_date)
query("dim_store")(marts.dim_store)
query("dim_product")(marts.dim_product)
query("dim_vendor")(marts.dim_vendor)
query("dim_customer")(lambda t: marts.dim_customer(t, SALT))
query("dim_promotion")(marts.dim_promotion)

# ---------------------------------------------------------------- KPIs
query("kpi_sales_per_sqm", p50_format=6)(kpis.kpi_sales_per_sqm)
query("kpi_tx_per_sqm", p50_format=8)(kpis.kpi_tx_per_sqm)
query("kpi_avg_ticket")(kpis.kpi_avg_ticket)
query("kpi_loyalty_conversion")(kpis.kpi_loyalty_conversion)
query("kpi_retention_m1")(kpis.kpi_retention_m1)
query("kpi_stockout_index")(lambda t: kpis.kpi_stockout_index(t, HORIZON))
query("kpi_margin_return")(kpis.kpi_margin_return)
query("kpi_availability")(lambda t: kpis.kpi_availability(t, HORIZON, CATEGORY_GRAIN))
query("kpi_health_score", health_score=8)(lambda t: kpis.kpi_health_score(t, *QUARTER, CATEGORY_GRAIN))

query("kpi_availability_daily")(lambda t: series.kpi_availability_daily(t, LOAD_CUT, HORIZON, CATEGORY_GRAIN))
query("kpi_stockout_daily")(lambda t: series.kpi_stockout_daily(t, FIRST_DAY, HORIZON, CATEGORY_GRAIN))
query("kpi_margin_return_monthly")(series.kpi_margin_return_monthly)
query("kpi_health_score_weekly", health_score=8)(lambda t: series.kpi_health_score_weekly(t, *CURRENT, CATEGORY_GRAIN))


# ---------------------------------------------------------------- incremental and streaming
def _stream_result(spark: SparkSession, stream: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """Drain a stream into a table on shared storage and read the table back."""
    folder = work_folder(spark, purpose)
    streams.run_available(stream, f"{folder}/table", f"{folder}/checkpoint", partition_by)
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


@session_query("stream_ingest")
def _ingest(spark: SparkSession, directory: str) -> DataFrame:
    raw = benchmark.raw_event_stream(spark, directory)
    stored = _stream_result(spark, streams.ingest(raw), "ingest", "arrival_date")
    return stored.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
        (F.length("row_hash") == 64).alias("hashed"), F.col("arrival_date").isNotNull().alias("dated"),
    )


@session_query("stream_ingest_ledger")
def _ingest_ledger(spark: SparkSession, directory: str) -> DataFrame:
    """The events in four files, two of which are sent again: under another name, one in another order."""
    folder = work_folder(spark, "ledger")
    events = benchmark.read_source(spark, directory, "events")
    part = F.col("user_id") % 4
    sent = [(k, events.filter(part == k)) for k in range(4)]
    # Ranges are sorted by a task each; the one that writes the file does not sort.
    turned = sinks.save(sent[1][1].orderBy(F.desc("event_id")), path=f"{folder}/turned")
    for name, rows in [*sent, ("1-again", turned), ("2-again", sent[2][1])]:
        rows.coalesce(1).write.parquet(f"{folder}/landing/{name}")
    landing = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).option("recursiveFileLookup", True)
    streams.ingest_once(landing.parquet(f"{folder}/landing"), f"{folder}/raw", f"{folder}/checkpoint")
    # The ledger knows how many rows there are, so no task counts more than a bounded share of them.
    count = streams.ledger(spark, f"{folder}/raw").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    stored = streams.ingested(spark, f"{folder}/raw", events.schema)
    dealt = stored.repartition(8 + count // LEDGER_TASK_ROWS, "source_hash", "event_id")
    return dealt.groupBy(part.alias("part"), "source_hash").agg(
        F.count("*").alias("rows"), F.count_distinct("event_id").alias("events"), F.count_distinct("source_file").alias("files")
    )


@session_query("stream_validate")
def _validate(spark: SparkSession, directory: str) -> DataFrame:
    checked = streams.validate(benchmark.event_stream(spark, directory), min_amount=1.0)
    return _stream_result(spark, checked, "validate", "verdict")


@session_query("stream_findings")
def _stream_findings(spark: SparkSession, directory: str) -> DataFrame:
    return streams.rejection_findings(_validate(spark, directory))


@session_query("stream_dedup")
def _dedup(spark: SparkSession, directory: str) -> DataFrame:
    feed = benchmark.event_stream(spark, directory)
    resent = benchmark.event_stream(spark, directory).withColumn("ts", F.col("ts") + F.make_dt_interval(mins=F.lit(20)))
    stored = _stream_result(spark, streams.dedup_feed(feed.union(resent)), "dedup")
    return stored.drop("ts")  # which copy comes first is open


@session_query("stream_hourly_sales")
def _hourly(spark: SparkSession, directory: str) -> DataFrame:
    return _stream_result(spark, streams.hourly_sales(benchmark.event_stream(spark, directory)), "hourly")


@session_query("stream_rolling_sales")
def _rolling(spark: SparkSession, directory: str) -> DataFrame:
    return _stream_result(spark, streams.rolling_sales_stream(benchmark.event_stream(spark, directory)), "rolling")


@session_query("stream_no_data_alert")
def _alerts(spark: SparkSession, directory: str) -> DataFrame:
    alerts = _stream_result(spark, streams.no_data_alerts(benchmark.event_stream(spark, directory)), "alerts")
    return alerts.select("store_id", "last_ts", "alert_at")


@session_query("stream_live_alerts")
def _live_alerts(spark: SparkSession, directory: str) -> DataFrame:
    """Stores 100 and 101 are active but never send a ticket."""
    stores = benchmark.retail_tables(spark, directory)["stores"].select("store_id")
    watched = stores.unionByName(stores.filter("store_id < 2").withColumn("store_id", F.col("store_id") + 100))
    feed = benchmark.event_stream(spark, directory)
    alerts = live_alerts(feed, watched, F.lit("2024-01-01 08:00:00").cast("timestamp"))
    folder = work_folder(spark, "live-alerts")
    run_alerts(alerts, f"{folder}/table", f"{folder}/checkpoint")
    return spark.read.schema(alerts.schema).parquet(f"{folder}/table")


@session_query("silent_intervals")
def _silent(spark: SparkSession, directory: str) -> DataFrame:
    stores = benchmark.retail_tables(spark, directory)["stores"]
    return incremental.silent_intervals(benchmark.event_feed(spark, directory), stores=stores)


@session_query("reprocess_window")
def _reprocess(spark: SparkSession, directory: str) -> DataFrame:
    feed = benchmark.event_feed(spark, directory)
    return incremental.reprocess_window(feed, feed.agg(F.max("ts")).scalar(), hours=72)


@session_query("rolling_sales")
def _rolling_batch(spark: SparkSession, directory: str) -> DataFrame:
    return incremental.rolling_sales(benchmark.event_feed(spark, directory))


@session_query("freshness_expected")
def _freshness(spark: SparkSession, directory: str) -> DataFrame:
    stores = benchmark.retail_tables(spark, directory)["stores"]
    return incremental.freshness_expected(benchmark.event_feed(spark, directory), stores=stores)


@session_query("stream_freshness")
def _stream_freshness(spark: SparkSession, directory: str) -> DataFrame:
    """The fourth week live, against the profile of the three weeks before; store 100 never reports."""
    folder, monday = work_folder(spark, "freshness"), F.lit("2024-01-22 00:00:00").cast("timestamp")
    stores = benchmark.retail_tables(spark, directory)["stores"].select("store_id")
    stores = stores.unionByName(stores.filter("store_id = 0").withColumn("store_id", F.col("store_id") + 100))
    profile = freshness.slot_profile(benchmark.event_feed(spark, directory), monday, stores=stores)
    profile = sinks.save(profile, path=f"{folder}/profile")
    live = benchmark.event_stream(spark, directory).filter((F.col("ts") >= monday) & (F.col("ts") < monday + F.expr("interval 7 days")))
    freshness.watch_freshness(live, profile, f"{folder}/judged", f"{folder}/checkpoint")
    return spark.read.schema("store_id int, hour timestamp, tickets long, expected double, late boolean").parquet(f"{folder}/judged").select(
        "store_id", "hour", "tickets", "expected", "late"
    )


@session_query("stream_upsert", total_amount=2)
def _upsert_stream(spark: SparkSession, directory: str) -> DataFrame:
    """Tickets as loaded before the cut date, and every ticket again as a stream of corrections."""
    t, folder = benchmark.retail_tables(spark, directory), work_folder(spark, "upsert-stream")
    columns = ("transaction_id", "total_amount", "status", "payment_method")
    target = sinks.save(
        _load_target(t).select(*columns, F.lit(0).alias("version")), path=f"{folder}/table", partition_by=("payment_method",)
    )
    _load_updates(t).select(*columns, F.lit(1).alias("version")).write.parquet(f"{folder}/landing")
    feed = spark.readStream.schema(target.schema).parquet(f"{folder}/landing")
    keys = ("transaction_id", "payment_method")
    streams.upsert_stream(feed, f"{folder}/table", f"{folder}/checkpoint", keys, "payment_method", "version")
    return spark.read.schema(target.schema).parquet(f"{folder}/table").select(*columns, "version")


def _load_target(t: Tables) -> DataFrame:
    """The table as loaded before the cut date."""
    return t["transactions"].filter(F.col("transaction_date") < F.lit(LOAD_CUT).cast("date"))


def _load_updates(t: Tables) -> DataFrame:
    """A full resend in which returned tickets carry a corrected amount."""
    corrected = F.when(F.col("status") == RETURNED, F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    return t["transactions"].withColumn("total_amount", corrected)


def _stored_hours(spark: SparkSession, path: str) -> DataFrame:
    schema = "store_id long, hour timestamp, tickets long, ventas_netas decimal(28,2), date date"
    return versions.read_parts(spark, path, T.StructType.fromDDL(schema)).drop("date")


@session_query("reprocess_written")
def _reprocess_written(spark: SparkSession, directory: str) -> DataFrame:
    """Tickets of the last 72 hours come late, and those of 3 o'clock are withdrawn."""
    feed, path = benchmark.event_feed(spark, directory), work_folder(spark, "hours")
    until = feed.agg(F.max("ts")).scalar()
    start = F.date_trunc("hour", until) - F.make_dt_interval(hours=F.lit(72))
    late = (F.col("ts") >= start) & (F.col("transaction_id") % 5 == 0)
    incremental.store_hours(feed.filter(~late), path)
    incremental.reprocess_hours(feed.filter(F.hour("ts") != 3), path, until, hours=72)
    return _stored_hours(spark, path)


@session_query("published_days")
def _published(spark: SparkSession, directory: str) -> DataFrame:
    """Daily totals of the feed, those of certified days only; on every third day a store is silent."""
    feed, path = benchmark.event_feed(spark, directory), work_folder(spark, "published")
    tickets = feed.withColumn("transaction_date", F.to_date("ts"))
    silent = (F.day("transaction_date") % 3 == 0) & (F.col("store_id") == 7)
    tables = {"stores": benchmark.retail_tables(spark, directory)["stores"], "transactions": tickets.filter(~silent)}
    mart = tables["transactions"].groupBy("store_id", F.col("transaction_date").alias("date")).agg(
        F.count("*").alias("tickets"), F.sum(net_amount()).alias("ventas_netas")
    )
    incremental.publish_certified(mart, incremental.day_certification(tables, "2024-01-01", "2024-01-31"), path)
    return versions.read_parts(spark, path, mart.schema)


@query("merge_upsert", total_amount=2)
def _merge(t: Tables) -> DataFrame:
    return incremental.merge_upsert(_load_target(t), _load_updates(t), ("transaction_id",))


@session_query("upsert_partitions", total_amount=2)
def _upsert(spark: SparkSession, directory: str) -> DataFrame:
    t = benchmark.retail_tables(spark, directory)
    path = work_folder(spark, "upsert")
    target = sinks.save(_load_target(t), path=path, partition_by=("payment_method",))
    keys = ("transaction_id", "payment_method")
    incremental.upsert_partitions(spark, path, _load_updates(t), keys, "payment_method")
    return spark.read.schema(target.schema).parquet(path).select(*t["transactions"].columns)


@query("latest_per_key")
def _latest(t: Tables) -> DataFrame:
    newest = incremental.latest_per_key(t["transaction_items"], ("transaction_item_id",), "unit_price")
    return newest.select("transaction_item_id", "transaction_id", "unit_price")


query("day_certification")(lambda t: incremental.day_certification(t, LOAD_CUT, HORIZON))
query("missing_store_days")(lambda t: incremental.missing_store_days(t, LOAD_CUT, HORIZON))
query("close_day")(incremental.close_day)
query("reconcile_metric")(incremental.reconcile_metric)
