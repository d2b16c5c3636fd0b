"""Every registered query against its SQL check, on the smallest scale."""

import pytest
from oracle_check import assert_same, connect

import __spark_entry__ as driver
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES



@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_check(spark, small, connection, name):
    assert_same(QUERIES[name](spark, small), connection, ORACLES[name])


def test_all_of_it_is_registered():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
