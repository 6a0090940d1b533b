from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tendero.operators import marts, quality, rollups, sales
from tendero.sources import sinks
from tests.conftest import day, line, records, ticket


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shop(make):
    rows = [ticket(f"t{m}-{d}-{s}", f"2025-{m:02}-{d:02}", s, 1.0 * d, customer=f"c{d % 4}") for m in (1, 2, 3, 4) for d in range(1, 9) for s in ("S1", "S2", "S3")]
    return make([*rows, rows[0]])  # one ticket twice


@pytest.fixture
def mart(make, tmp_path):
    return shop(make), rollups.save_store_day(shop(make), str(tmp_path / "mart"))


def test_a_period_opens_its_months_only(spark, mart):
    t, stored = mart
    rows = rollups.store_day_between(stored, "2025-02-05", "2025-03-02", country="CR")
    want = sales.store_day(t, country="CR", start="2025-02-05", end="2025-03-02")
    columns = [c for c in want.columns]
    assert records(rows, *columns) == records(want, *columns)
    scan = re.search(r"FileScan parquet[^\n]*", plan_of(rows)).group(0)
    assert "PartitionFilters: [isnotnull(month" in scan and "202502" in scan and "202503" in scan
    # The metrics of the scan say how many files were opened.
    rows.collect()
    assert files_read(rows) == {"202502", "202503"}


def files_read(df) -> set[str]:
    return {re.search(r"month=(\d+)", r[0]).group(1) for r in df.select(F.input_file_name()).distinct().collect()}


def test_a_selection_of_the_date_dimension_prunes_when_it_runs(spark, mart, tmp_path):
    t, stored = mart
    dates = sinks.save(marts.dim_date(t, "2025-01-01", "2025-12-31"), path=str(tmp_path / "dates"))
    rows = rollups.store_day_on(stored, dates.filter("trimestre = 2 AND anio = 2025"))
    assert {r.date.month for r in rows.collect()} == {4} and rows.count() == 24
    assert "dynamicpruning" in plan_of(rows).lower()


def test_sketches_merge_to_distinct_counts(mart):
    t, stored = mart
    by_month = rollups.distinct_rollup(stored, "month", "country")
    got = {(r.month, r.country): (r.tickets_estimate, r.customers_estimate) for r in by_month.collect()}
    assert got[(202501, "CR")] == (16, 4) and got[(202502, "GT")] == (8, 4) and len(got) == 8
    weeks = rollups.distinct_rollup(stored, "week_start").collect()
    assert sum(r.tickets_estimate for r in weeks) == 96
    plan = plan_of(by_month)
    assert "transaction_id" not in plan and "partial_hll_union_agg" in plan


def test_estimates_stay_within_their_error(spark, make):
    t = make([])
    many = spark.range(60_000).select(
        F.concat(F.lit("t"), F.col("id")).alias("transaction_id"), F.concat(F.lit("c"), F.col("id") % 20_000).alias("customer_id"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("transaction_date"), F.lit("S1").alias("store_id"),
        F.lit(1.0).alias("total_amount"), F.lit("CASH").alias("payment_method"), F.lit(True).alias("loyalty_card"), F.lit("COMPLETED").alias("status"),
    )
    t["transactions"] = many
    row = rollups.distinct_rollup(rollups.store_day_mart(t), "format").first()
    bound = 3 * 1.04 / 2 ** (rollups.LOG_K / 2)
    assert abs(row.tickets_estimate / 60_000 - 1) < bound and abs(row.customers_estimate / 20_000 - 1) < bound


def test_rules_against_a_stored_dimension_and_stored_gaps(spark, make):
    t = make(
        [ticket("a", "2025-01-05", customer="C"), ticket("b", "2025-03-05", customer="C"), ticket("c", "2025-02-05", customer="D")],
        [line("1", "a", "I1"), line("2", "b", "I1")],
    )
    months = spark.createDataFrame(
        [("C", day("2025-02-01")), ("D", day("2025-02-01")), (None, day("2025-01-01"))], "customer_id string, mes_primera_compra date"
    )
    gaps = spark.createDataFrame(
        [("S1", "I1", day("2025-01-06")), ("S1", "I1", day("2025-01-05")), ("S1", "I2", day("2025-02-01"))],
        "store_id string, item_id string, fecha_inicio_ausencia date",
    )
    got = {r.rule: (r.failed, r.total) for r in quality.dq_kpi_rules(t, "2025-04-01", first_months=months, gaps=gaps).collect()}
    assert got["mes_relativo_negativo"] == (1, 3) and got["cohorte_sin_cliente"] == (1, 3)
    assert got["ausencia_sin_ventas_previas"] == (2, 3)
    assert "cohorte_sin_cliente" not in {r.rule for r in quality.dq_kpi_rules(t, "2025-04-01").collect()}
