"""Helpers that the corpus operators share."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tendero.session import work_folder

# Long texts: an Arrow batch of this many rows, or as many as make this many bytes, stays small in a
# Python worker.
BATCH_ROWS, BATCH_BYTES = "512", "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text (null: empty); whatever other columns there are do not matter."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame that is read more than once to shared storage.  This cuts the lineage: an
    executor that is lost later takes nothing with it."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@functools.lru_cache(1)
def held(kind: Callable | None, *given):
    """``kind(*given)``, one a Python worker: the tasks that it runs one after another share it.  A worker
    holds one such thing, and lets go of it when it goes on with an operator that has none."""
    return kind(*given) if kind else None


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str, shared: bool = False
) -> DataFrame:
    """Arrow batches through a function that ``make`` builds once in each Python task; ``shared``:
    from what the worker has ``held`` for it."""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not shared:
            held(None)
        work = make()
        for batch in batches:
            found = work(batch)
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in (found[n] for n in names)],
                names=names,
            )

    return df.mapInArrow(run, schema)


def slots(df: DataFrame, keys: list[str], order: list[str], out: str, buckets: int = 1024) -> DataFrame:
    """Number the rows of each key from 0 without a gap, though one key may hold most rows.

    Rows are dealt into ``buckets`` by a hash of ``order``; each bucket of a key is numbered on its
    own and moved up by the count of the buckets before it.  ``df`` is read twice and has to be
    the same each time (see ``materialise``).  ``keys`` may not be null."""
    dealt = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        dealt.groupBy(*keys, "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    within = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order))
    numbered = dealt.withColumn("_within", within.cast("long") - 1).join(base, [*keys, "_b"])
    return numbered.withColumn(out, F.col("_base") + F.col("_within")).drop("_b", "_base", "_within")
