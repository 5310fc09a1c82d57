"""Every query of the library itself against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__
from bazaar.plans.oracles import oracle_sql
from bazaar.plans.registry import queries
from compare import connect, differences
from conftest import TESTDATA


@pytest.fixture(scope="module")
def con():
    connection = connect(TESTDATA)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle_sql())


def test_all_are_registered():
    assert set(queries()) <= set(__spark_entry__.queries())
    assert oracle_sql().items() <= __spark_entry__.oracle_sql().items()


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, con, name):
    assert differences(queries()[name](spark, TESTDATA), con, oracle_sql()[name]) == []


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == [
        "year",
        "month",
        "number_of_orders",
        "total_revenue",
        "average_order_value",
    ]
