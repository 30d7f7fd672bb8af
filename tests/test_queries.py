"""The registered queries against their SQL on the smallest tables."""

import os

import pytest

from checks.compare import compare, database
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(FOLDER):
        pytest.skip("no test tables")
    return database(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    verdict, _, _ = compare(spark, con, FOLDER, name)
    assert verdict.startswith("ok") or (name not in ORACLES and verdict.startswith("rows only"))
