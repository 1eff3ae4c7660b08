"""The registered queries against their SQL, on the smallest data set."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from checks.compare import database, differences
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data here")


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert name in entry_point.queries() and name in entry_point.oracle_sql()
    count, difference = differences(spark, con, SF, name)
    assert difference == "" and count > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
