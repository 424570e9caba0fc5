"""Every checked query against its SQL on the smallest data."""

import pytest

import __spark_entry__ as driver
from checks.catalog import ORACLES, QUERIES
from checks.compare import compare, database

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    outcome = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert outcome.startswith(("ok", "rows")), outcome


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).columns == ["email", "term", "score"]
