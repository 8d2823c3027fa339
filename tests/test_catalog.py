"""Every query with SQL gives the SQL's rows; the others keep their invariants."""

from __future__ import annotations

import pytest
from parity import connect, difference

from vigora.plans import catalog


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_rows_are_the_sql_s(spark, small, con, name):
    assert difference(catalog.QUERIES[name](spark, small), con, catalog.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_queries_without_sql_have_rows(spark, small, name):
    assert catalog.QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
