"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the local core count.  A query is timed from
building its plan to having every result row computed (written to the no-op sink)."""

from __future__ import annotations

import json
import os
import sys
import time

from tendero.plans import registry
from tendero.session import build_session

HEADLINE = (
    "stock_gaps_item",
    "stock_gaps",
    "stock_gaps_calendar",
    "comp_sales_store",
    "store_productivity",
    "cohort_retention",
    "vendor_margin_return",
    "promo_impact",
    "pareto",
    "weekly_change",
    "category_recommendation",
    "dq_findings",
    "store_day",
    "fact_sales_item",
    "welch_test",
    "kpi_health_score",
    "merge_upsert",
    "stream_hourly_sales",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    names = tuple(sys.argv[1:]) or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, directory).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("net_sales_by_format")  # start executors and load classes before timing
    times = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(directory.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
