"""Registered queries against their SQL on the smallest tables."""

import pytest

from cadenza.llm.queries import ORACLES, QUERIES
from cadenza.sources.tables import TABLES
from tools.oracle_check import compare, duck_connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    r = compare(spark, duck_connect(SF, TABLES), key, QUERIES[key], ORACLES[key], SF)
    assert r["status"] == "ok", r
