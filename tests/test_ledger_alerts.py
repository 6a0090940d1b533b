from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tendero.operators import incremental
from tendero.streaming import feed as streams
from tendero.streaming.alerts import live_alerts, run_alerts
from tests.conftest import records

SCHEMA = "transaction_id long, ts timestamp, store_id long, total_amount double, status string"


def at(hour, minute=0, day=1, micro=0):
    return dt.datetime(2024, 1, day, hour, minute, 0, micro)


def send(spark, folder, name, rows):
    full = [(key, ts, store, 1.0, "COMPLETED") for key, ts, store in rows]
    spark.createDataFrame(full, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder, files=1):
    reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", "*.parquet").parquet(folder)


# ---------------------------------------------------------------- ledger
FILE = [(1, at(9), 1), (2, at(10), 1), (2, at(10), 1)]


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "raw"), str(tmp_path / "check")


def stored(spark, path):
    return records(streams.ingested(spark, path, spark.createDataFrame([], SCHEMA).schema), "transaction_id", "ts")


def test_a_file_sent_again_adds_no_row(spark, places):
    landing, raw, check = places
    send(spark, landing, "a", FILE)
    send(spark, landing, "same-batch", FILE[::-1])
    send(spark, landing, "b", [(1, at(9, micro=1), 1), *FILE[1:]])  # a microsecond makes another file
    streams.ingest_once(stream(spark, landing, 2), raw, check)
    send(spark, landing, "next-day", FILE)
    streams.ingest_once(stream(spark, landing), raw, check)
    assert len(stored(spark, raw)) == 6
    assert sorted(r.rows for r in streams.ledger(spark, raw).collect()) == [3, 3]


def test_a_replay_with_or_without_its_checkpoint_changes_nothing(spark, places, tmp_path):
    landing, raw, check = places
    send(spark, landing, "a", FILE)
    send(spark, landing, "b", [(5, at(1), 2)])
    streams.ingest_once(stream(spark, landing, 2), raw, check)
    before = stored(spark, raw)
    streams.ingest_once(stream(spark, landing, 2), raw, check)
    streams.ingest_once(stream(spark, landing, 1), raw, str(tmp_path / "another"))
    assert stored(spark, raw) == before and streams.ledger(spark, raw).count() == 2


def test_rows_of_a_load_that_was_cut_off_are_not_read(spark, places, monkeypatch):
    landing, raw, check = places
    send(spark, landing, "a", FILE)

    def lost(*_):
        raise RuntimeError("the driver is lost before the ledger is written")

    with monkeypatch.context() as broken:
        broken.setattr(type(spark.range(1)), "coalesce", lost)
        with pytest.raises(Exception, match="ledger"):
            streams.ingest_once(stream(spark, landing), raw, check)
    assert spark.read.parquet(f"{raw}/rows").count() == 3 and stored(spark, raw) == []
    send(spark, landing, "b", [(7, at(2), 2)])
    streams.ingest_once(stream(spark, landing, 2), raw, check)
    assert [r[0] for r in stored(spark, raw)] == [1, 2, 2, 7]


def test_rows_of_a_large_file_are_stored_by_several_tasks(spark, places):
    landing, raw, _ = places
    rows = [(k, at(9, micro=k), 1, k / 7, "COMPLETED") for k in range(4000)]
    one = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    one.write.option("parquet.block.size", 8192).parquet(f"{landing}/a")
    sizes = {"spark.sql.files.maxPartitionBytes": "8192", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in sizes}
    for key, size in sizes.items():
        spark.conf.set(key, size)
    try:
        batch = streams.ingest(spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(landing))
        streams.load_batch(batch, raw)
    finally:
        for key, size in before.items():
            spark.conf.set(key, size)
    assert len(stored(spark, raw)) == 4000
    assert spark.read.parquet(f"{raw}/rows").select(F.input_file_name()).distinct().count() > 1


# ---------------------------------------------------------------- alerts
def tickets(seed, days=4, stores=4):
    rng = random.Random(seed)
    out = [(k, at(8, k, 1), k) for k in range(stores)]  # each store reports soon after opening
    for _ in range(40 * days):
        day, hour = rng.randint(1, days), rng.randint(0, 23)
        out.append((len(out), at(hour, rng.randint(0, 59), day, rng.randint(0, 999_999)), rng.randrange(stores)))
    return sorted(out, key=lambda r: r[1])


def drained(spark, tmp_path, batches, restart=False):
    landing, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    watched = spark.createDataFrame([(k,) for k in (0, 1, 2, 3, 50)], "store_id long")

    def run():
        alerts = live_alerts(stream(spark, landing), watched, F.lit(at(8)))
        streams.run_available(alerts, out, check)
        return alerts.schema

    for n, batch in enumerate(batches):
        send(spark, landing, f"{n:03}", batch)
        if restart:
            schema = run()
    if not restart:
        schema = run()
    return records(spark.read.schema(schema).parquet(out), "store_id", "last_ts", "alert_at")


@pytest.mark.parametrize("restart", [False, True])
def test_live_alerts_are_those_of_the_batch_form(spark, tmp_path, restart):
    rows = tickets(3)
    third = len(rows) // 3
    batches = [rows[:third], rows[third : 2 * third], rows[2 * third :]]
    late = batches[1].pop(0)  # arrives a batch later, but before its delay is over
    batches[1].append(late)
    got = drained(spark, tmp_path, batches, restart)
    feed = spark.createDataFrame([(k, ts, s, 1.0, "COMPLETED") for k, ts, s in rows], SCHEMA)
    stores = spark.createDataFrame([(50,), (0,)], "store_id long")
    silent = incremental.silent_intervals(feed, stores=stores)
    end = max(ts for _, ts, _ in rows) - dt.timedelta(hours=2)
    assert got == records(silent.filter(F.col("alert_at") <= F.lit(end)), "store_id", "last_ts", "alert_at")
    assert (50, None, at(10)) in got and len(got) > 4


def test_a_late_ticket_ends_a_silence_before_its_alert(spark, tmp_path):
    batches = [
        [(1, at(9), 0), (2, at(12), 1)],
        [(3, at(10, 30), 0), (4, at(12, 10), 1)],  # store 0 was heard of at 10:30: not silent since 9
        [(5, at(18), 2)],
    ]
    got = drained(spark, tmp_path, batches, restart=True)
    assert [r for r in got if r[0] == 0] == [(0, at(10, 30), at(12, 30))]
    assert [r for r in got if r[0] == 1] == [(1, None, at(10)), (1, at(12, 10), at(14, 10))]
    assert [r for r in got if r[0] == 2] == [(2, None, at(10))]


def test_alerts_run_in_a_session_without_rocksdb(spark, tmp_path):
    landing, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    send(spark, landing, "a", [(1, at(9), 0), (2, at(18), 1)])
    watched = spark.createDataFrame([(0,), (7,)], "store_id long")
    key = "spark.sql.streaming.stateStore.providerClass"
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(key)
    spark.conf.set(key, plain)
    try:
        alerts = live_alerts(stream(spark, landing), watched, F.lit(at(8)))
        run_alerts(alerts, out, check)
        assert spark.conf.get(key) == plain
    finally:
        spark.conf.set(key, before)
    got = records(spark.read.schema(alerts.schema).parquet(out), "store_id", "last_ts", "alert_at")
    assert got == [(0, at(9), at(11)), (7, None, at(10))]


def test_tickets_without_time_or_store(spark, tmp_path):
    got = drained(spark, tmp_path, [[(1, at(9), 0), (2, None, 0), (3, at(9, 30), None), (4, at(18), 1)]])
    assert [r for r in got if r[0] in (0, None)] == [(None, at(9, 30), at(11, 30)), (0, at(9), at(11))]
