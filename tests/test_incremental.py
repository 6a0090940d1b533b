from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tendero.functions import row_hash, surrogate_key
from tendero.operators import incremental as inc
from tendero.sources import sinks
from tests.conftest import day, line, one, records, ticket

ROW = "k string, v int, p string"


def test_upsert_actions(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", None, "x")], ROW)
    updates = spark.createDataFrame([("b", 2, "x"), ("c", 3, "x"), ("d", 4, "x")], ROW)
    merged = inc.merge_upsert(target, updates, ("k",))
    assert records(merged, "k", "v", "merge_action") == [
        ("a", 1, "kept"), ("b", 2, "unchanged"), ("c", 3, "updated"), ("d", 4, "inserted"),
    ]


def test_upsert_can_set_a_null(spark):
    target = spark.createDataFrame([("a", 1, "x")], ROW)
    merged = inc.merge_upsert(target, spark.createDataFrame([("a", None, "x")], ROW), ("k",))
    assert records(merged, "k", "v", "merge_action") == [("a", None, "updated")]


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x")], ROW)
    updates = spark.createDataFrame([("b", 5, "x"), ("d", 4, "x")], ROW)
    once = inc.merge_upsert(target, updates, ("k",)).drop("merge_action")
    twice = inc.merge_upsert(once, updates, ("k",))
    assert records(twice.drop("merge_action")) == records(once)
    assert {r.merge_action for r in twice.collect()} == {"kept", "unchanged"}


def test_latest_version_wins_with_many_copies(spark):
    copies = [("hot", i, "x", i % 1000) for i in range(2000)] + [(f"k{i}", i, "x", 1) for i in range(1000)]
    updates = spark.createDataFrame(copies, ROW + ", ver int").repartition(8)
    latest = inc.latest_per_key(updates, ("k",), "ver")
    assert latest.count() == 1001
    # Versions 999 exist twice; row content settles it, the same way every time.
    values = {inc.latest_per_key(updates.repartition(n), ("k",), "ver").filter("k = 'hot'").collect()[0].v for n in (1, 3, 7)}
    assert len(values) == 1 and values <= {999, 1999}
    merged = inc.merge_upsert(spark.createDataFrame([], ROW + ", ver int"), updates, ("k",), "ver")
    assert merged.count() == 1001 and {r.merge_action for r in merged.collect()} == {"inserted"}


def test_row_hash_tells_null_from_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a")], "x string, y string")
    assert df.select(row_hash(["x", "y"])).distinct().count() == 2


def test_partition_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.save(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], ROW), path=path, partition_by=("p",))
    before = {f.name for f in (tmp_path / "t" / "p=y").iterdir()}
    inc.upsert_partitions(spark, path, spark.createDataFrame([("a", 9, "x"), ("c", 3, "z")], ROW), ("k", "p"), "p")
    assert records(spark.read.parquet(path), "k", "v", "p") == [("a", 9, "x"), ("b", 2, "y"), ("c", 3, "z")]
    assert {f.name for f in (tmp_path / "t" / "p=y").iterdir()} == before
    with pytest.raises(ValueError):
        inc.upsert_partitions(spark, path, spark.createDataFrame([("a", 1, "y")], ROW), ("k",), "p")


def test_upsert_keeps_a_null_partition_and_partitions_that_look_like_numbers(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.save(spark.createDataFrame([("k1", 1, None), ("k2", 2, "01"), ("k4", 4, "02")], ROW), path=path, partition_by=("p",))
    updates = spark.createDataFrame([("k3", 3, None), ("k2", 5, "01")], ROW)
    for _ in range(2):  # a replay changes nothing
        inc.upsert_partitions(spark, path, updates, ("k", "p"), "p")
        stored = spark.read.schema(ROW).parquet(path)
        assert records(stored, "k", "v", "p") == [("k1", 1, None), ("k2", 5, "01"), ("k3", 3, None), ("k4", 4, "02")]


def test_older_versions_never_win(spark):
    versioned = ROW + ", ver int"
    target = spark.createDataFrame([("a", 50, "x", 5), ("b", 1, "x", None)], versioned)
    updates = spark.createDataFrame([("a", 30, "x", 3), ("b", 2, "x", 1), ("c", 7, "x", 1), ("c", 8, "x", 2)], versioned)
    merged = inc.merge_upsert(target, updates, ("k",), "ver")
    assert records(merged, "k", "v", "ver", "merge_action") == [
        ("a", 50, 5, "unchanged"), ("b", 2, 1, "updated"), ("c", 8, 2, "inserted"),
    ]
    with pytest.raises(ValueError):
        inc.merge_upsert(target.drop("ver"), updates, ("k",), "ver")


@pytest.mark.parametrize("rows", [[("a", 1, "x"), ("a", 2, "x")], [(None, 1, "x")]])
def test_upsert_refuses_doubled_and_null_keys(spark, rows):
    target = spark.createDataFrame([("a", 0, "x")], ROW)
    with pytest.raises(Exception, match="an update h"):
        inc.merge_upsert(target, spark.createDataFrame(rows, ROW), ("k",)).collect()


def test_surrogate_keys_do_not_collide(spark):
    rows = [("A", None), (None, "A"), ("a|b", "c"), ("a", "b|c"), ("", ""), (None, None), (None, "")]
    keys = [r[0] for r in spark.createDataFrame(rows, "x string, y string").select(surrogate_key("x", "y")).collect()]
    assert keys[5] is None and len(set(keys)) == len(rows)
    assert spark.createDataFrame([(None,)], "x string").select(surrogate_key("x")).first()[0] is None


def test_certification(make):
    t = make([ticket("1", "2024-06-01", "S1"), ticket("2", "2024-06-01", "S2"), ticket("3", "2024-06-01", "S3"), ticket("4", "2024-05-31", "S1")])
    got = records(inc.day_certification(t, "2024-05-31", "2024-06-01"), "date", "stores_expected", "stores_missing", "certified")
    assert got == [(day("2024-05-31"), 2, 1, False), (day("2024-06-01"), 3, 0, True)]
    assert records(inc.missing_store_days(t, "2024-05-31", "2024-06-01")) == [("S2", day("2024-05-31"))]


def feed(spark, *rows):
    data = [(i, dt.datetime.fromisoformat(ts), store, 10.0, "COMPLETED") for i, (ts, store) in enumerate(rows)]
    return spark.createDataFrame(data, "transaction_id long, ts timestamp, store_id long, total_amount double, status string")


def test_silence(spark):
    df = feed(spark, ("2024-01-01T09:00:00", 1), ("2024-01-01T09:59:00", 1), ("2024-01-01T12:00:00", 1),
              ("2024-01-01T13:59:59", 1), ("2024-01-01T21:00:00", 2), ("2024-01-01T23:30:00", 2), ("2024-01-01T10:00:00", 3))
    got = [(r.store_id, r.last_ts.strftime("%H:%M:%S"), r.alert_at.strftime("%H:%M"), r.next_ts) for r in inc.silent_intervals(df).orderBy("store_id", "last_ts").collect()]
    assert [(a, b, c) for a, b, c, _ in got] == [(1, "09:59:00", "11:59"), (1, "13:59:59", "15:59"), (3, "10:00:00", "12:00")]
    assert all(t is None for s, _, _, t in got if s == 3)
    assert got[0][3] is not None and got[1][3] is None
    exact = feed(spark, ("2024-01-01T09:00:00", 1), ("2024-01-01T11:00:00", 1), ("2024-01-01T11:00:01", 1))
    assert inc.silent_intervals(exact).count() == 1  # exactly two hours is silence


def test_silence_over_night_and_stores_that_never_report(spark):
    df = feed(spark, ("2024-01-01T21:30:00", 1), ("2024-01-01T21:30:00", 2), ("2024-01-02T09:59:00", 2), ("2024-01-05T06:30:00", 4),
              ("2024-01-05T12:00:00", 9))
    stores = spark.createDataFrame([(1,), (2,), (3,)], "store_id long")
    got = {(r.store_id, r.last_ts, r.alert_at) for r in inc.silent_intervals(df, stores=stores).collect()}
    at = dt.datetime
    assert got == {
        (1, at(2024, 1, 1, 21, 30), at(2024, 1, 2, 10)),  # due at 23:30, so two hours after opening
        (2, at(2024, 1, 2, 9, 59), at(2024, 1, 2, 11, 59)),
        (3, None, at(2024, 1, 2, 10)),
        (4, at(2024, 1, 5, 6, 30), at(2024, 1, 5, 10)),
    }
    late = inc.freshness_expected(df, stores=stores).filter("store_id = 3")
    assert late.count() == late.filter("late").count() > 80


def test_freshness_counts_silent_hours(spark):
    monday = dt.datetime(2024, 1, 1, 10)
    rows = [((monday + dt.timedelta(weeks=w, minutes=m)).isoformat(), 1) for w in range(3) for m in range(4)]
    rows += [((monday + dt.timedelta(weeks=3, hours=1)).isoformat(), 1)]
    out = inc.freshness_expected(feed(spark, *rows))
    slot = out.filter(F.col("hour") == F.lit(monday + dt.timedelta(weeks=3))).collect()[0]
    assert (slot.tickets, slot.expected, slot.late) == (0, 4.0, True)


def test_rolling_and_reprocess(spark):
    df = feed(spark, ("2024-01-01T09:10:00", 1), ("2024-01-01T09:50:00", 1), ("2024-01-01T11:05:00", 1), ("2024-01-01T12:30:00", 1))
    rolled = {r.window_start.hour: r.tickets for r in inc.rolling_sales(df).collect()}
    assert rolled == {7: 2, 8: 2, 9: 3, 10: 2, 11: 2, 12: 1}
    redone = inc.reprocess_window(df, F.lit(dt.datetime(2024, 1, 1, 12, 40)), 3)
    assert [(r.hour.hour, r.tickets) for r in redone.orderBy("hour").collect()] == [(9, 2), (11, 1)]


def test_reconcile_and_close(make):
    t = make(
        [ticket("a", "2025-01-01", "S1", 10.0), ticket("b", "2025-01-02", "S1", 5.0, "RETURNED"), ticket("c", "2025-01-02", "S2", 7.0)],
        [line("1", "a", "I1", 1, 9.0), line("2", "b", "I1", 1, 5.0)],
    )
    got = {(r.store_id, r.status): (float(r.diferencia), r.tickets, r.tickets_con_items) for r in inc.reconcile_metric(t).collect()}
    assert got == {("S1", "COMPLETED"): (1.0, 1, 1), ("S1", "RETURNED"): (0.0, 1, 1), ("S2", "COMPLETED"): (7.0, 1, 0)}
    closed = one(inc.close_day(t))
    assert (closed.transaction_date, closed.transacciones) == (day("2025-01-01"), 1)
