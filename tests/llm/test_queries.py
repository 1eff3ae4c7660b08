"""The registered queries on the smallest data set, beside their SQL where they have some."""

from pathlib import Path

import pytest

from checks.compare import database, differences
from corpus_pipeline import run
from reportloom.llm.oracles import ORACLES
from reportloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data here")


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_query(spark, con, name):
    count, difference = differences(spark, con, SF, name, {**QUERIES, "pipeline": run}, ORACLES)
    assert difference == "" and count > 0
