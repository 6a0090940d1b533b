from __future__ import annotations

import os

import pytest

from tendero.llm import registry

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="benchmark data not present")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_oracle(name, spark):
    connection = pytest.importorskip("duckdb").connect()
    for view in ("documents", "conversations"):
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{DIRECTORY}/{view}.parquet'")
    cursor = connection.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    want = sorted(tuple(r) for r in cursor.fetchall())
    found = registry.queries()[name](spark, DIRECTORY)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == want
