"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from tidemark import queries as registered

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(TABLES)


@pytest.mark.parametrize("name", list(registered.queries()))
def test_same_rows_as_sql(spark, duck, name):
    assert differences(spark, duck, TABLES, name) == ""


def test_every_query_has_sql():
    assert set(registered.queries()) == set(registered.oracle_sql())
    assert set(registered.queries()) <= set(contract.queries())


def test_entry_returns_the_order_lines(spark):
    rows = contract.entry(spark)
    assert len(rows.columns) == 26
    assert rows.count() == 6000
