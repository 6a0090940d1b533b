"""Standard views every other operator starts from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendero.functions import line_amount, line_cost, money, net_amount, signed
from tendero.schemas import COMPLETED, TABLE_NAMES, Tables

DateLike = str | Column


def as_date(value: DateLike) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast("date")


def last_date(tables: Tables, completed_only: bool = False) -> Column:
    """The newest transaction date as a scalar subquery: one value, no join and no collect."""
    tx = tables["transactions"]
    if completed_only:
        tx = tx.filter(F.col("status") == COMPLETED)
    return tx.agg(F.max("transaction_date")).scalar()


def horizon_or_last(tables: Tables, horizon: DateLike | None, completed_only: bool = False) -> Column:
    return last_date(tables, completed_only) if horizon is None else as_date(horizon)


def completed(tables: Tables) -> DataFrame:
    return tables["transactions"].filter(F.col("status") == COMPLETED)


def between_dates(df: DataFrame, start: DateLike | None, end: DateLike | None, column: str = "transaction_date"):
    if start is not None:
        df = df.filter(F.col(column) >= as_date(start))
    if end is not None:
        df = df.filter(F.col(column) <= as_date(end))
    return df


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def net_transactions(tables: Tables) -> DataFrame:
    return tables["transactions"].withColumn("ventas_netas", net_amount())


def item_sales(tables: Tables) -> DataFrame:
    """Item lines with their product, gross amount and cost."""
    products = tables["products"].select("item_id", "item_name", "category", "vendor_id", "cost")
    return tables["transaction_items"].join(products, "item_id").select(
        "transaction_item_id", "transaction_id", "item_id", "item_name", "category", "vendor_id",
        "quantity", "unit_price", "cost", "was_on_promo",
        line_amount().alias("ventas_brutas_item"),
        line_cost().alias("costo_item"),
    )


def signed_transactions(tables: Tables) -> DataFrame:
    """Transactions with the sign of their status and the net amount."""
    return tables["transactions"].withColumns({"sign": signed(F.lit(1)), "net_gmv": net_amount()})


def sales_enriched(tables: Tables) -> DataFrame:
    """One wide row per item line: ticket, product, store and vendor attributes plus signed line
    amount and cost.  The two ``country`` columns are told apart by name."""
    stores = tables["stores"].withColumnRenamed("country", "store_country")
    vendors = tables["vendors"].withColumnRenamed("country", "vendor_country")
    wide = (
        tables["transaction_items"]
        .join(tables["transactions"], "transaction_id")
        .join(tables["products"], "item_id", "left")
        .join(stores, "store_id", "left")
        .join(vendors, "vendor_id", "left")
    )
    return wide.withColumns(
        {
            "line_gmv": line_amount(),
            "net_gmv": net_amount(),
            "net_line_gmv": signed(line_amount()),
            "net_cost": signed(line_cost()),
        }
    )


TICKET_LINES = "ticket_lines"


def ticket_lines(tables: Tables) -> DataFrame:
    """Item lines of completed tickets with all that item-grain operators read of either side.  Stored and
    given as the table ``ticket_lines``, it takes the place of their join."""
    tickets = completed(tables).select(
        "transaction_id", "store_id", "transaction_date", money("total_amount").alias("ticket")
    )
    lines = tables["transaction_items"].select(
        "transaction_id", "item_id", "quantity", "was_on_promo", line_amount().alias("line")
    )
    return lines.join(tickets, "transaction_id")


def completed_lines(tables: Tables, ticket_columns: tuple[str, ...] = ("store_id", "transaction_date")) -> DataFrame:
    """Item lines of completed tickets.  The only large join of the item-grain marts: both sides
    are pruned to the needed columns and meet on ``transaction_id``, unless they were stored together."""
    if TICKET_LINES in tables:
        return tables[TICKET_LINES].select("transaction_id", "item_id", "quantity", "line", *ticket_columns)
    tickets = completed(tables).select("transaction_id", *ticket_columns)
    lines = tables["transaction_items"].select(
        "transaction_id", "item_id", "quantity", line_amount().alias("line")
    )
    return lines.join(tickets, "transaction_id")


def table_counts(tables: Tables) -> DataFrame:
    return union_all(
        [
            tables[t].agg(F.count("*").alias("filas")).select(F.lit(t).alias("tabla"), "filas")
            for t in TABLE_NAMES
            if t in tables
        ]
    )


def load_validation(tables: Tables) -> DataFrame:
    """Row counts, with the date range of transactions."""
    no_date = F.lit(None).cast("date")
    reports = []
    for name in TABLE_NAMES:
        dated = name == "transactions"
        report = tables[name].agg(
            F.count("*").alias("filas"),
            (F.min("transaction_date") if dated else F.first(no_date)).alias("fecha_minima"),
            (F.max("transaction_date") if dated else F.first(no_date)).alias("fecha_maxima"),
        )
        reports.append(report.select(F.lit(name).alias("tabla"), "filas", "fecha_minima", "fecha_maxima"))
    return union_all(reports)
