"""Queries that SQL can express, against that SQL."""

from __future__ import annotations

import compare
import pytest
from conftest import TESTDATA

from bazaar.llm.queries import oracle_sql, queries


@pytest.fixture(scope="module")
def con():
    import duckdb

    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations", "pages"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(queries()[name](spark, TESTDATA), con, oracle_sql()[name]) == []


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in queries()] == [f"op{n}" for n in range(1, 14)]
