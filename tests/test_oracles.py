"""Every registered query against its SQL oracle on the smallest benchmark data."""

from __future__ import annotations

import glob
import os

import pytest

import __spark_entry__ as entry
from tendero.plans import oracles, registry

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="benchmark data not present")


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{DIRECTORY}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def ordered(columns, rows):
    positions = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in positions) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert registry.queries().keys() == oracles.oracle_sql().keys()
    assert registry.queries().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_matches_oracle(name, spark, sql):
    df = registry.queries()[name](spark, DIRECTORY)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    cursor = sql.execute(oracles.oracle_sql()[name])
    want = ordered([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == entry.entry(spark).columns and df.count() > 0
