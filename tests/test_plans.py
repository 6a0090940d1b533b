"""Physical plans: what must hold at any scale."""

from __future__ import annotations

import os
import re

import pytest

from tendero.plans import registry as entry
from tendero.sources import benchmark
from tendero.operators import base, cohorts, marts, mix, sales, stockgaps
from tendero.plans import jobs

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="benchmark data not present")

STREAMED = {n for n in entry.queries() if n.startswith("stream_")}
STORED = {
    "export_reports", "stored_layout", "dq_kpi_rules", "store_day_stored", "store_day_quarter", "distinct_rollup",
    "load_csv", "save_table", "run_marts", "export_csv", "export_json", "upsert_partitions", "load_csv_bad_rows", "reprocess_written", "published_days"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Dimensions too big to broadcast: every join must still have a distributed plan."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - STREAMED - STORED))
def test_no_cross_join_and_no_forced_broadcast(name, spark, no_broadcast):
    plan = plan_of(entry.queries()[name](spark, DIRECTORY))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BroadcastHashJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python


def test_one_fact_join_for_shares_of_a_total(spark, no_broadcast):
    t = benchmark.retail_tables(spark, DIRECTORY)
    for frame in (mix.category_recommendation(t, "2001-08-01"), mix.category_share(t)):
        assert plan_of(frame).count("FileScan parquet [l_orderkey") == 1


def test_customers_in_one_pass(spark):
    t = benchmark.retail_tables(spark, DIRECTORY)
    assert len(re.findall(r"FileScan parquet \[o_", plan_of(marts.dim_customer(t, "salt")))) == 1


def test_filters_and_columns_reach_the_scan(spark):
    t = benchmark.retail_tables(spark, DIRECTORY)
    plan = plan_of(sales.comp_sales_store(t, "2001-01-01", "2001-06-30"))
    scan = re.search(r"FileScan parquet \[o_custkey[^\n]*", plan).group(0)
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(o_orderdate,2001-01-01" in scan
    assert "o_orderpriority" not in scan and "o_orderkey" not in scan


def test_stock_gaps_prunes_lines_and_uses_one_window(spark):
    t = benchmark.retail_tables(spark, DIRECTORY)
    plan = plan_of(stockgaps.stock_gaps(t, horizon="2001-08-01"))
    scan = re.search(r"FileScan parquet \[l_orderkey[^\n]*", plan).group(0)
    assert "l_discount" not in scan and "l_tax" not in scan
    assert plan.count("Window [") == 1


def test_lines_combine_before_they_shuffle(spark, no_broadcast):
    t = benchmark.retail_tables(spark, DIRECTORY)
    pairs = plan_of(mix.promo_impact_long(t))
    # The ticket join's partitioning serves the (ticket, category) reduction: no exchange for it.
    assert not re.search(r"Exchange hashpartitioning\(transaction_id#\d+L, category#\d+", pairs)
    cohort = plan_of(cohorts.cohort_activity(t))
    assert "partial_count(distinct" not in cohort and cohort.count("SortMergeJoin") == 1  # orders with customers only


def test_marts_join_lines_and_tickets_once(spark, tmp_path):
    tables = benchmark.retail_tables(spark, DIRECTORY)
    assert plan_of(base.ticket_lines(tables)).count("FileScan parquet [l_orderkey") == 1
    shared = jobs.with_shared_lines(tables, str(tmp_path))
    frames = {name: plan() for name, plan in jobs.mart_plans(shared, entry.PERIODS).items()}
    assert not any("[l_orderkey" in plan_of(frame) for frame in frames.values())
    readers = {name for name, frame in frames.items() if any("_ticket_lines" in f for f in frame.inputFiles())}
    assert readers == {"retorno_margen", "quiebres_stock", "promociones"}


def test_counted_marts_are_not_read_again(spark, tmp_path):
    counted = {}
    marts = jobs.run_marts(benchmark.retail_tables(spark, DIRECTORY), entry.PERIODS, str(tmp_path), counted)
    assert counted == {r.tabla: r.filas for r in jobs.mart_counts(marts).collect()}
