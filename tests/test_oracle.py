"""Every query of the catalogue against its SQL, row by row."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from creditloom.plans.catalog import CATALOG
from creditloom.plans.oracles import ORACLES
from tests.compare import differences, oracle

SF_DIR = "/root/testdata/sf0.001"

QUERIES, SQL = CATALOG, ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = oracle(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry_point.queries().items()
    assert SQL.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() == 150
