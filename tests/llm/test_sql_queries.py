"""Queries with SQL against their SQL."""

from __future__ import annotations

import pytest

from eventloom.llm.oracles import ORACLES
from eventloom.llm.queries import QUERIES
from parity.check import database, differences
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), database(SMALL), ORACLES[name]) == ""
