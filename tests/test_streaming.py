from __future__ import annotations

import datetime as dt

from tendero.operators import incremental
from tendero.streaming import feed as streams
from tests.conftest import records

SCHEMA = "transaction_id long, ts timestamp, store_id long, total_amount double, status string"


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 1, day, hour, minute)


def rows_of(*rows):
    return [(key, ts, store, amount, "COMPLETED") for key, ts, store, amount in rows]


def drain(spark, tmp_path, batches, transform, partition_by=()):
    """Each batch arrives as its own file and is processed as its own micro-batch."""
    source = str(tmp_path / "in")
    for batch in batches:
        spark.createDataFrame(rows_of(*batch), SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet").parquet(source)
    out = transform(stream)
    streams.run_available(out, str(tmp_path / "out"), str(tmp_path / "check"), partition_by)
    return spark.read.schema(out.schema).parquet(str(tmp_path / "out"))


def test_hourly_windows_take_late_tickets_within_two_hours(spark, tmp_path):
    out = drain(
        spark, tmp_path,
        [
            [(1, at(9, 5), 1, 10.0), (2, at(10, 30), 1, 5.0)],
            [(3, at(9, 45), 1, 1.0), (4, at(13, 0), 1, 1.0)],  # 9:45 is 45 minutes late: counted
            [(6, at(16, 0), 1, 1.0)],
            [(5, at(9, 50), 1, 99.0), (8, at(16, 5), 1, 1.0)],  # the 9:00 hour has been emitted
        ],
        streams.hourly_sales,
    )
    got = {r.window_start.hour: (r.tickets, float(r.ventas_netas)) for r in out.collect()}
    assert got == {9: (2, 11.0), 10: (1, 5.0), 13: (1, 1.0)}


def test_dedup_across_and_within_batches(spark, tmp_path):
    copies = [(7, at(9, 0), 1, 1.0)] * 300
    out = drain(
        spark, tmp_path,
        [[*copies, (8, at(9, 1), 1, 1.0)], [(7, at(9, 0), 1, 1.0), (9, at(9, 30), 1, 1.0)]],
        streams.dedup_feed,
    )
    assert records(out, "transaction_id") == [(7,), (8,), (9,)]


def test_validation_splits_by_verdict(spark, tmp_path):
    out = drain(
        spark, tmp_path,
        [[(1, at(9), 1, 10.0), (None, at(9), 1, 10.0), (2, None, 1, 10.0), (3, at(9), None, 10.0), (4, at(9), 1, None), (5, at(9), 1, 0.0)]],
        streams.validate, ("verdict",),
    )
    assert records(out, "transaction_id", "verdict") == [
        (None, "missing_key"), (1, "ok"), (2, "missing_time"), (3, "missing_store"), (4, "missing_amount"), (5, "nonpositive_amount"),
    ]
    assert (tmp_path / "out" / "verdict=ok").is_dir()
    findings = {r.check: (r.failed, r.total) for r in streams.rejection_findings(out).collect()}
    assert len(findings) == 5 and findings["missing_time"] == (1, 6)


def test_alerts_match_the_batch_twin(spark, tmp_path):
    batches = [
        [(1, at(9), 1, 1.0), (2, at(10), 1, 1.0), (3, at(9, 30), 2, 1.0)],
        [(4, at(13), 1, 1.0), (5, at(10, 15), 2, 1.0), (6, at(20, 30), 2, 1.0)],
        [(7, at(9, 0, 2), 1, 1.0), (8, at(20, 0, 2), 2, 1.0)],
    ]
    out = drain(spark, tmp_path, batches, streams.no_data_alerts)
    everything = spark.createDataFrame(rows_of(*[r for b in batches for r in b]), SCHEMA)
    twin = incremental.silent_intervals(everything).filter("next_ts IS NOT NULL OR alert_at <= timestamp'2024-01-02 18:00:00'")
    assert records(out, "store_id", "last_ts", "alert_at") == records(twin, "store_id", "last_ts", "alert_at")
    assert out.count() > 0


def test_ingest_carries_source_and_fingerprint(spark, tmp_path):
    out = drain(spark, tmp_path, [[(1, at(9), 1, 1.0)], [(2, at(9), 1, 1.0)]], streams.ingest, ("arrival_date",))
    rows = out.collect()
    assert len({r.row_hash for r in rows}) == 2 and all(r.source_file.endswith(".parquet") for r in rows)
    assert all(r.arrival_date is not None for r in rows)


def test_a_file_sent_again_has_the_same_fingerprint(spark, tmp_path):
    batch = [(1, at(9), 1, 1.0), (2, at(10), 1, 2.0)]
    out = drain(spark, tmp_path, [batch, batch[::-1], batch[:1]], streams.ingest, ("arrival_date",))
    found = streams.file_fingerprints(out).collect()
    assert len(found) == 3 and sorted(r.rows for r in found) == [1, 2, 2]
    assert len({r.source_hash for r in found}) == 2


def test_dedup_counts_copies_in_event_time(spark, tmp_path):
    big = 9007199254740992
    out = drain(
        spark, tmp_path,
        [
            [(1, at(12), 1, 1.0)],
            [(2, at(5), 1, 1.0), (2, at(12, 5), 1, 1.0), (big, at(12, 6), 1, 1.0), (big + 1, at(12, 6), 1, 1.0), (None, at(12, 6), 1, 1.0)],
        ],
        streams.dedup_feed,
    )
    assert records(out, "transaction_id") == [(None,), (1,), (2,), (big,), (big + 1,)]


def test_upsert_stream_replay_changes_nothing(spark, tmp_path):
    path, source = str(tmp_path / "table"), str(tmp_path / "in")
    columns = "transaction_id long, total_amount double, p string, ver int"
    spark.createDataFrame([(1, 1.0, "x", 0)], columns).write.partitionBy("p").parquet(path)
    for batch in ([(1, 2.0, "x", 1), (1, 3.0, "x", 2), (2, 5.0, "y", 1)], [(2, 6.0, "y", 3), (1, 9.0, "x", 1)]):
        spark.createDataFrame(batch, columns).coalesce(1).write.mode("append").parquet(source)

    def run(checkpoint):
        stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(source)
        streams.upsert_stream(stream, path, str(tmp_path / checkpoint), ("transaction_id", "p"), "p", "ver")
        return records(spark.read.parquet(path), "transaction_id", "total_amount", "p")

    first = run("c1")
    assert first == [(1, 3.0, "x"), (2, 6.0, "y")]
    assert run("c2") == first  # a lost checkpoint replays everything


def test_rolling_stream(spark, tmp_path):
    out = drain(spark, tmp_path, [[(1, at(9, 10), 1, 1.0), (2, at(11, 0), 1, 1.0)], [(3, at(20, 0), 1, 1.0)]], streams.rolling_sales_stream)
    assert {r.window_start.hour: r.tickets for r in out.collect()} == {7: 1, 8: 1, 9: 2, 10: 1, 11: 1}
