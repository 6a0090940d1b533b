from __future__ import annotations

import datetime as dt

import pytest

from tendero.schemas import SCHEMAS
from tendero.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


STORES = [
    ("S1", "Uno", "CR", "San José", "EXPRESS", 100, day("2023-01-01"), "Sur"),
    ("S2", "Dos", "CR", "San José", "EXPRESS", 200, day("2023-01-01"), "Sur"),
    ("S3", "Tres", "GT", "Xela", "DESCUENTO", 50, day("2024-06-01"), "Norte"),
]
VENDORS = [("V1", "Proveedor 1", "CR", "A", True)]
PRODUCTS = [
    ("I1", "Televisor", "M", "V1", "Electrónica", "Dep", 4.0),
    ("I2", "Pan", "M", "V9", "Alimentos", "Dep", 1.0),
    ("I3", "Leche", "M", None, "Alimentos", "Dep", 2.0),
]


def ticket(key, date, store="S1", amount=10.0, status="COMPLETED", customer=None, card=None):
    card = customer is not None if card is None else card
    return (key, customer, day(date), store, amount, "CASH", card, status)


def line(key, ticket_key, item="I1", quantity=1, price=10.0, promo=False):
    return (key, ticket_key, item, quantity, price, promo)


@pytest.fixture(scope="session")
def make(spark):
    """Build the six tables from rows; whatever is left out gets the small defaults above."""

    def build(transactions=(), items=(), stores=STORES, products=PRODUCTS, vendors=VENDORS, promotions=()):
        given = {
            "transactions": transactions, "transaction_items": items, "stores": stores,
            "products": products, "vendors": vendors, "store_promotions": promotions,
        }
        return {name: spark.createDataFrame(list(rows), SCHEMAS[name]) for name, rows in given.items()}

    return build


def records(df, *columns, sort=True):
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r]) if sort else rows


def one(df):
    (row,) = df.collect()
    return row
