"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution splits skewed join partitions and picks partition counts at run time.  Stream
# state lives in RocksDB, off the heap, and sessions of a busy store merge before they shuffle.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A shuffled join whose measured partitions fit hashes them instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str = "tendero", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, whatever the session says: states with timers or
    with more than one variable need it.  The session has its own setting again afterwards."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, RECOMMENDED_CONF[key])
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder on storage that the driver and all executors share: below
    ``spark.checkpoint.dir``, or below the session's warehouse where that is unset.  Never a
    machine's own temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
