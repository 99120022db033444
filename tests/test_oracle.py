"""Every registered query against its SQL."""

from __future__ import annotations

import __spark_entry__ as entry
import pytest

from tests.conftest import SMALL
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_sql():
    """Only those of the optional subpackage may have none."""
    assert set(entry.oracle_sql()) <= set(entry.queries())
    optional = {name for name in entry.queries() if name == "pipeline" or name.startswith("op")}
    assert set(entry.queries()) - set(entry.oracle_sql()) <= optional


def test_entry_is_the_rental_fact(spark):
    fact = entry.entry(spark)
    assert fact.columns == ["store_id", "rental_date", "payment_date", "amount"]
    assert fact.count() > 0


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    assert difference(entry.queries()[name](spark, SMALL), connection, entry.oracle_sql()[name]) is None
