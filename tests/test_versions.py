from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tendero.operators import incremental
from tendero.sources import versions
from tests.conftest import day, records, ticket

FEED = "transaction_id long, ts timestamp, store_id long, total_amount double, status string"


def at(hour, minute=0, day_=1):
    return dt.datetime(2024, 1, day_, hour, minute)


def feed(spark, *tickets):
    return spark.createDataFrame([(k, ts, store, amount, "COMPLETED") for k, ts, store, amount in tickets], FEED)


def dates(spark, *texts):
    return spark.createDataFrame([(day(t),) for t in texts], "date date")


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(day(f"2024-01-0{d}"), d, v) for d in (1, 2, 3) for v in "ab"], "date date, k int, v string")
    versions.replace_parts(rows, path, "date", rows.select("date"))
    return path, rows.schema


def test_parts_are_replaced_together_and_emptied_ones_go(spark, table):
    path, schema = table
    new = spark.createDataFrame([(day("2024-01-02"), 20, "x"), (day("2024-01-09"), 9, "not named")], schema)
    assert versions.replace_parts(new, path, "date", dates(spark, "2024-01-02", "2024-01-03")) == 2
    assert records(versions.read_parts(spark, path, schema), "k", "v") == [(1, "a"), (1, "b"), (20, "x")]
    assert versions.read_parts(spark, path, schema, version=1).count() == 6
    assert versions.superseded(spark, path).count() == 2


def test_a_commit_that_is_cut_off_changes_nothing_and_can_be_repeated(spark, table):
    path, schema = table
    new = spark.createDataFrame([(day("2024-01-01"), 7, "n")], schema)
    reader = versions.read_parts(spark, path, schema)  # began before
    versions.stage(new, path, "date")  # written, but the writer is lost before the commit
    assert versions.read_parts(spark, path, schema).count() == 6 and versions.latest_version(spark, path) == 1
    versions.replace_parts(new, path, "date", dates(spark, "2024-01-01"))
    assert records(versions.read_parts(spark, path, schema).filter("k < 2 OR k = 7"), "k") == [(7,)]
    assert reader.count() == 6


def test_an_empty_table_and_only_the_parts_asked_for(spark, table, tmp_path):
    path, schema = table
    some = versions.read_parts(spark, path, schema, parts=["2024-01-03"])
    assert some.count() == 2 and all("_part=2024-01-03" in f for f in some.inputFiles())
    assert versions.read_parts(spark, str(tmp_path / "none"), schema).count() == 0
    versions.replace_parts(spark.createDataFrame([], schema), path, "date", dates(spark, "2024-01-01", "2024-01-02", "2024-01-03"))
    assert versions.read_parts(spark, path, schema).count() == 0


def test_reprocessing_writes_late_hours_back_and_clears_empty_ones(spark, tmp_path):
    path = str(tmp_path / "hours")
    first = [(1, at(22, 5), 1, 10.0), (2, at(23, 10), 1, 5.0), (3, at(1, 0, 2), 2, 7.0), (4, at(2, 30, 2), 1, 1.0), (5, at(9, 0), 1, 3.0)]
    incremental.store_hours(feed(spark, *first), path)
    # Ticket 6 came late, ticket 3 was withdrawn, and the amount of ticket 1 lies outside the window.
    now = [(1, at(22, 5), 1, 99.0), (2, at(23, 10), 1, 5.0), (6, at(23, 50), 1, 2.0), (4, at(2, 30, 2), 1, 1.0), (5, at(9, 0), 1, 3.0)]
    incremental.reprocess_hours(feed(spark, *now), path, F.lit(at(2, 10, 2)), hours=3)
    schema = incremental.hourly_tickets(feed(spark)).withColumn("date", F.to_date("hour")).schema
    stored = versions.read_parts(spark, path, schema)
    got = {(r.hour, r.store_id): (r.tickets, float(r.ventas_netas)) for r in stored.collect()}
    assert got == {
        (at(9), 1): (1, 3.0), (at(22), 1): (1, 10.0), (at(23), 1): (2, 7.0), (at(2, 0, 2), 1): (1, 1.0),
    }
    before = versions.latest_version(spark, path)
    incremental.reprocess_hours(feed(spark, *now), path, F.lit(at(2, 10, 2)), hours=3)  # a replay
    assert records(versions.read_parts(spark, path, schema)) == records(stored) and versions.latest_version(spark, path) == before + 1


def test_a_day_that_is_emptied_whole_is_gone(spark, tmp_path):
    path = str(tmp_path / "hours")
    incremental.store_hours(feed(spark, (1, at(10), 1, 1.0), (2, at(10, 0, 2), 1, 1.0)), path)
    incremental.reprocess_hours(feed(spark, (1, at(10), 1, 1.0)), path, F.lit(at(0, 0, 3)), hours=24)
    assert [r.part for r in versions.current_parts(spark, path).collect()] == ["2024-01-01"]


def test_only_certified_days_are_published(spark, make, tmp_path):
    path = str(tmp_path / "published")
    t = make([ticket("a", "2025-01-01", "S1"), ticket("b", "2025-01-01", "S2"), ticket("c", "2025-01-02", "S1")])
    t["stores"] = t["stores"].filter("store_id <> 'S3'")
    mart = t["transactions"].select("store_id", F.col("transaction_date").alias("date"), "transaction_id")
    incremental.publish_certified(mart, incremental.day_certification(t, "2025-01-01", "2025-01-02"), path)
    read = lambda: records(versions.read_parts(spark, path, mart.schema), "transaction_id")
    assert read() == [("a",), ("b",)]
    # The second day is completed; the first one, now blocked, keeps what was published.
    later = make([ticket("b2", "2025-01-01", "S2"), ticket("c", "2025-01-02", "S1"), ticket("d", "2025-01-02", "S2")])
    later["stores"] = t["stores"]
    mart = later["transactions"].select("store_id", F.col("transaction_date").alias("date"), "transaction_id")
    incremental.publish_certified(mart, incremental.day_certification(later, "2025-01-01", "2025-01-02"), path)
    assert read() == [("a",), ("b",), ("c",), ("d",)]
