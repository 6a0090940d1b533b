"""Live alerts for stores that send no data, also for those that never sent any.

Each active store has a state from the start, so a store without a single ticket is due like any other.  The
state is the last ticket that no late one can precede any more, and the first and last ticket of each clock hour
since: a silence of an hour or more runs from the last ticket of one hour to the first of a later one.  It is
bounded by the hours of the watermark's delay, whatever the load.  A timer wakes the store when an hour is
complete or its alert is due; tickets move the alert on."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tendero.operators.incremental import alert_time
from tendero.session import rocksdb_state
from tendero.streaming.feed import run_available

HOUR = 3_600_000_000  # in microseconds
FOUND = "store_id long, last_at long, due long"


class SilenceProcessor(StatefulProcessor):
    """All moments are microseconds; when a ticket's alert is due comes with the ticket."""

    def init(self, handle: Any) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "at long, due long, alerted boolean")
        self._hours = handle.getMapState("hours", "hour long", "first long, last long, due long")

    def handleInitialState(self, key: Any, initialState: Any, timerValues: Any) -> None:
        self._last.update((None, int(initialState["due"].iloc[0]), False))
        self._handle.registerTimer(-(-int(initialState["due"].iloc[0]) // 1000))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for tickets in rows:
            hours = tickets.groupby(tickets["at"] // HOUR).agg(first=("at", "min"), last=("at", "max"), due=("due", "max"))
            for hour, first, last, due in hours.itertuples():
                known = self._hours.getValue((hour,)) if self._hours.containsKey((hour,)) else None
                if known is not None:
                    first, last, due = min(first, known[0]), max(last, known[1]), max(due, known[2])
                self._hours.updateValue((hour,), (int(first), int(last), int(due)))
        yield self._judged(key, timerValues)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield self._judged(key, timerValues)

    def _judged(self, key: Any, timerValues: Any) -> pd.DataFrame:
        """Alerts that are certain by now; sets the timer for what is next."""
        now = timerValues.getCurrentWatermarkInMs() * 1000
        state = self._last.get() if self._last.exists() else None
        at, due, alerted = state if state is not None else (None, None, True)
        hours = sorted((k[0], *v) for k, v in self._hours.iterator())
        found = []

        def judge(following: int | None) -> None:
            nonlocal alerted
            if not alerted and due <= now and (following is None or following >= due):
                found.append((key[0], at, due))
                alerted = True

        while hours and (hours[0][0] + 1) * HOUR <= now:
            hour, first, last, next_due = hours.pop(0)
            judge(first)
            at, due, alerted = last, next_due, False
            self._hours.removeKey((hour,))
        judge(hours[0][1] if hours else None)
        if due is not None:
            self._last.update((at, due, alerted))
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        waits = ([(hours[0][0] + 1) * HOUR] if hours else []) + ([due] if not alerted else [])
        if any(w > now for w in waits):
            self._handle.registerTimer(-(-min(w for w in waits if w > now) // 1000))
        frame = pd.DataFrame(found, columns=["store_id", "last_at", "due"])
        return frame.astype({"store_id": "Int64", "last_at": "Int64", "due": "int64"})

    def close(self) -> None:
        pass


def live_alerts(
    feed: DataFrame, stores: DataFrame, since: Column, silence_hours: int = 2, delay: str = "2 hours",
    opening: int = 8, closing: int = 22,
) -> DataFrame:
    """Stores that were silent for ``silence_hours`` of opening time, as a stream: (store_id, last_ts, alert_at).
    ``stores`` are the active ones, watched from ``since`` on; ``last_ts`` is NULL for a store that had not sent
    anything by then.  Each silence alerts once, as soon as no late ticket can end it before its alert.  Tickets
    of stores that are not among ``stores`` are watched from their first one on.  Start the stream in a session
    with RocksDB state, or by ``run_alerts``."""
    if silence_hours < 1:
        raise ValueError("silence_hours must be at least 1")

    def due(moment: Column) -> Column:
        return F.unix_micros(alert_time(moment, silence_hours, opening, closing))

    watched = stores.select(F.col("store_id").cast("long").alias("store_id")).distinct().withColumn("due", due(since))
    tickets = feed.withWatermark("ts", delay).filter("ts IS NOT NULL").select(
        F.col("store_id").cast("long").alias("store_id"), "ts", F.unix_micros("ts").alias("at"), due(F.col("ts")).alias("due")
    )
    alerts = tickets.groupBy("store_id").transformWithStateInPandas(
        SilenceProcessor(), FOUND, "Append", "EventTime", initialState=watched.groupBy("store_id")
    )
    return alerts.select(
        "store_id", F.timestamp_micros("last_at").alias("last_ts"), F.timestamp_micros("due").alias("alert_at")
    )


def run_alerts(alerts: DataFrame, path: str, checkpoint: str) -> None:
    """``run_available`` for the stream of ``live_alerts``, in any session."""
    with rocksdb_state(alerts.sparkSession):
        run_available(alerts, path, checkpoint)
