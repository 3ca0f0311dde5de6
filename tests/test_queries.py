"""Every registered query against its SQL on the smallest data set."""

import pytest
from conftest import SF
from oracle_check import compare, connect

import __spark_entry__ as entry
from tickermill.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    diff, _, _, rows, _ = compare(spark, duck, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert diff == [] and rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
