"""Each query against its SQL equivalent on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
SQL = driver.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_equivalent_has_a_query():
    assert set(SQL) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(driver.queries()[name](spark, FOLDER), con, SQL[name]) == []


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() == 3
