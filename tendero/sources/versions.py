"""A Parquet table whose days (or other parts) are replaced together, by versions.

New parts are written whole to a folder of their own.  Only then does one small file in ``manifest``
name them, and that file is what makes them part of the table: a reader sees all parts of a commit or none,
a commit that is cut off before leaves the table as it was, and a reader that began earlier keeps its files.
A part that a commit names without rows is gone.  There is one row of the manifest for each part and
commit, so a part is a day or a month, not a key.

One writer at a time: commits are numbered, and two that begin from the same version would get the same
number.  Files of older versions stay until somebody removes what ``superseded`` lists."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "version long, part string, folder string"
PART = "_part"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(version, part, folder) of all commits; a folder of NULL is a part that went."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def latest_version(spark: SparkSession, path: str) -> int:
    return manifest(spark, path).agg(F.max("version")).first()[0] or 0


def current_parts(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(part, folder) of a version, by default of the newest one."""
    commits = manifest(spark, path)
    if version is not None:
        commits = commits.filter(F.col("version") <= version)
    newest = commits.groupBy("part").agg(F.max_by("folder", "version").alias("folder"))
    return newest.filter(F.col("folder").isNotNull())


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """Folders that no longer belong to the newest version."""
    return manifest(spark, path).select("folder").na.drop().distinct().join(current_parts(spark, path), "folder", "left_anti")


def read_parts(
    spark: SparkSession, path: str, schema: T.StructType, version: int | None = None, parts: list[str] | None = None
) -> DataFrame:
    """The table as of a version; ``parts`` names those to be read, so that no other file is opened."""
    found = current_parts(spark, path, version)
    if parts is not None:
        found = found.filter(F.col("part").isin(parts))
    folders = [r.folder for r in found.select("folder").collect()]  # one for each day of the table
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def stage(rows: DataFrame, path: str, part: str) -> str:
    """Write rows to a fresh folder below ``path``, by part.  Nothing of it belongs to the table yet."""
    folder = f"{path}/data/{uuid.uuid4().hex}"
    # Rebalancing lets AQE split a part that holds most rows and join the small ones.
    named = rows.withColumn(PART, F.col(part).cast("string"))
    named.hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(folder)
    return folder


def commit(spark: SparkSession, path: str, folder: str, parts: DataFrame) -> int:
    """Make the parts staged in ``folder`` those of the table; ``parts`` (one column) names all that
    are replaced.  Gives the number of the version."""
    version = latest_version(spark, path) + 1
    filled = spark.read.schema(f"{PART} string").parquet(folder).select(F.col(PART).alias("part")).distinct()
    named = parts.select(F.col(parts.columns[0]).cast("string").alias("part")).distinct()
    inside = filled.withColumn("folder", F.concat(F.lit(f"{folder}/{PART}="), F.col("part")))
    entries = named.join(inside, "part", "left").select(F.lit(version).cast("long").alias("version"), "part", "folder")
    entries.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def replace_parts(rows: DataFrame, path: str, part: str, parts: DataFrame) -> int:
    """Replace the parts that ``parts`` names by the rows that fall into them, all at once."""
    if part not in rows.columns:
        raise ValueError(f"no such column: {part}")
    names = parts.select(F.col(parts.columns[0]).alias(part)).distinct()
    return commit(rows.sparkSession, path, stage(rows.join(names, part, "left_semi"), path, part), names)
