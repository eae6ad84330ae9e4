"""Every registered query with a SQL twin equals DuckDB cell for cell (sf0.001)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from check_oracle import compare, duck

KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_builder():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 70


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_duckdb(spark, con, key):
    ok, msg = compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "asset_id", "timestamp", "split", "anomaly_score", "anomaly_pred"]
