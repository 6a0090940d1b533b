"""Saving results, ad-hoc SQL over registered views, and catalog listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendero.schemas import Tables


def register_views(tables: Tables) -> None:
    """Expose the base tables, plus the two standard views, to ``spark.sql``."""
    from tendero.operators.base import item_sales, net_transactions

    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    if "transactions" in tables:
        net_transactions(tables).createOrReplaceTempView("v_transacciones_ventas_netas")
    if {"transaction_items", "products"} <= tables.keys():
        item_sales(tables).createOrReplaceTempView("v_items_ventas")


def save(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Replace a stored result and return it read back from storage."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path and table")
    writer = df.write.mode("overwrite").format(fmt)
    # A partitioned overwrite replaces the whole result, not only the partitions it holds.
    writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table is not None:
        writer.saveAsTable(table)
        return df.sparkSession.table(table)
    writer.save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path)


def export(df: DataFrame, path: str, fmt: str = "csv", lines: int | None = None) -> str:
    """Write a result for another tool: CSV with a header, or one JSON record per line."""
    out = df if lines is None else df.limit(lines)
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.format(fmt).save(path)
    return path


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)


def run_sql(
    spark: SparkSession, query: str, limit: int | None = None, save_as: str | None = None
) -> DataFrame:
    """Run a user's SQL text over the registered views, optionally stored as a table."""
    result = spark.sql(query.strip().rstrip(";"))
    if save_as is not None:
        result = save(result, table=save_as)
    return result if limit is None else preview(result, limit)


def list_tables(spark: SparkSession) -> DataFrame:
    rows = [("view" if t.isTemporary or t.tableType == "VIEW" else "table", t.name) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "tipo string, nombre string").orderBy("tipo", "nombre")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    if not spark.catalog.tableExists(name):
        raise ValueError(f"no such table or view: {name}")
    rows = [(i, c.name, c.dataType, c.nullable) for i, c in enumerate(spark.catalog.listColumns(name))]
    return spark.createDataFrame(rows, "cid int, nombre string, tipo string, nullable boolean").orderBy(F.col("cid"))
