"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from parity.check import database, differences
from parity.queries import REGISTRY
from tests.conftest import SMALL

QUERIES = {name: query for name, query in contract.queries().items() if name in REGISTRY}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def connection():
    return database(SMALL)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) == set(QUERIES)


def test_entry_has_rows(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "repo_id", "repo_name", "score", "stars_7d", "forks_7d", "prs_7d", "rank_position",
    ]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SMALL), connection, SQL[name]) == ""
