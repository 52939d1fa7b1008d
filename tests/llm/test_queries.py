"""The registered queries on the smallest tables: SQL, or the shape of the contract."""

from __future__ import annotations

import pytest

from creditloom.llm import queries
from tests.compare import differences, oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = oracle(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):
    query = queries.QUERIES[name](spark, SF_DIR)
    assert differences(query, duck, queries.ORACLES[name]) is None


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
