"""Every registered query that SQL can express gives the oracle's names, types and values."""

import pytest

import __spark_entry__ as entry
from compare import compare, oracle_connection


@pytest.fixture(scope="module")
def con(sf):
    return oracle_connection(sf)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, sf, con, name):
    ok, text, rows = compare(name, entry.queries()[name](spark, sf), entry.oracle_sql()[name], con)
    assert ok, text


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
