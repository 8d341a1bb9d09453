"""Every registered query against its SQL, value by value."""

import pytest
from check import connect, differences

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, con, sf_dir, name):
    assert differences(spark, con, name, sf_dir) is None


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert not entry(spark).isEmpty()
