"""The registered queries of the subpackage against their SQL."""

import os

import pytest

from checks.compare import compare, database
from gleanery.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(FOLDER):
        pytest.skip("no test tables")
    return database(FOLDER)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, con, name):
    verdict, _, _ = compare(spark, con, FOLDER, name, QUERIES, ORACLES)
    assert verdict.startswith("ok")
