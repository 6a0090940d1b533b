from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tendero.operators import incremental
from tendero.streaming import freshness
from tests.conftest import records
from tests.test_ledger_alerts import SCHEMA, send, stream

UNTIL = dt.datetime(2024, 1, 22)


def tickets():
    rng, out = random.Random(8), []
    for day in range(28):
        for store in range(3):
            if store == 2 and day < 10:
                continue  # opens later
            for _ in range(rng.randint(10, 40)):
                moment = dt.datetime(2024, 1, 1) + dt.timedelta(days=day, minutes=rng.randrange(24 * 60))
                if store == 1 and moment >= UNTIL and moment.hour in (3, 4):
                    continue  # silent in these hours of the last week
                out.append((len(out), moment, store))
    return out


@pytest.mark.parametrize("restart", [False, True])
def test_the_live_week_is_judged_as_by_the_batch_form(spark, tmp_path, restart):
    rows = tickets()
    feed = spark.createDataFrame([(k, ts, s, 1.0, "COMPLETED") for k, ts, s in rows], SCHEMA)
    stores = spark.createDataFrame([(0,), (1,), (2,), (9,)], "store_id long")
    profile = freshness.slot_profile(feed, F.lit(UNTIL), stores=stores).cache()
    assert profile.count() == 4 * 168
    landing, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    live = sorted((r for r in rows if r[1] >= UNTIL), key=lambda r: r[1])
    for n in range(3):
        send(spark, landing, str(n), live[n * len(live) // 3 : (n + 1) * len(live) // 3])
        if restart or n == 2:
            freshness.watch_freshness(stream(spark, landing), profile, out, check)
    judged = spark.read.schema("store_id long, hour timestamp, tickets long, expected double, late boolean").parquet(out)
    got = {(r.store_id, r.hour): (r.tickets, r.expected, r.late) for r in judged.select("store_id", "hour", "tickets", "expected", "late").collect()}
    batch = incremental.freshness_expected(feed, stores=stores).filter(F.col("hour") >= F.lit(UNTIL)).collect()
    want = {(r.store_id, r.hour): (r.tickets, r.expected if r.store_id != 9 else None, r.late) for r in batch}
    closed = max(ts for _, ts, _ in live) - dt.timedelta(hours=3)
    sold = {ts.replace(minute=0) for _, ts, _ in live}
    ends = min(sold), max(h for h in sold if h <= closed)
    assert len(got) == judged.count() and {hour for _, hour in got} == {h for _, h in want if ends[0] <= h <= ends[1]}
    assert {hour for _, hour in got} - sold  # hours in which nobody sold anything
    assert all(got[k] == want[k] for k in got)
    assert any(late for (store, hour), (_, _, late) in got.items() if store == 1 and hour.hour == 3)
    assert all(late for (store, _), (_, _, late) in got.items() if store == 9)


def test_hours_meet_the_stores_of_their_slot(spark):
    feed = spark.createDataFrame([(1, dt.datetime(2024, 1, 22, 5), 1, 1.0, "COMPLETED")], SCHEMA)
    profile = freshness.slot_profile(feed, F.lit(UNTIL))
    assert records(profile) == []  # nothing before
    closed = feed.select(F.date_trunc("hour", "ts").alias("window_start"), "store_id", F.lit(1).cast("long").alias("tickets"))
    known = spark.createDataFrame([(1, 0, 5, 4.0, True), (2, 0, 5, 0.0, True)], "store_id long, slot_day int, slot_hour int, expected double, reported boolean")
    hours = closed.select(F.col("window_start").alias("hour"))
    judged = records(freshness.judged_hours(closed, hours, known), "store_id", "tickets", "late")
    assert judged == [(1, 1, True), (2, 0, False)]
