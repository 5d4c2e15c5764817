"""Every registered query against its SQL on the smallest data."""

import os

import pytest

from requestlens.catalog import ORACLES, QUERIES
from tests.oracle_check import connect, differences

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_states_its_result():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    rows, problems = differences(spark, connection, FOLDER, name, QUERIES, ORACLES)
    assert not problems
    assert rows > 0
