"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF, entry.queries()[name], entry.oracle_sql().get(name)) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
