"""Every registered query against its DuckDB oracle, on the smallest tables."""

import os

import pytest

os.environ.setdefault("ORACLE_EXACT", "1")   # floats must match bit for bit

import __spark_entry__ as entry  # noqa: E402
from cadenza.plans.catalog import ORACLES, QUERIES  # noqa: E402
from tools.oracle_check import compare, duck_connect  # noqa: E402
from cadenza.sources.tables import TABLES  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL, TABLES)


def test_every_query_has_an_oracle_or_reason():
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()
    missing = set(QUERIES) - set(ORACLES)
    assert not missing


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, QUERIES[key], ORACLES.get(key), SF_SMALL)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["query_id", "user_emotions", "rank", "artist", "song", "link",
                          "llm_labeled_emotions", "score"]
    assert df.count() > 0
