"""Every entry of the registry against its DuckDB oracle on sf0.001 (the driver
uses sf0.01): row count, column names, order-insensitive value hash."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF_SMALL  # noqa: E402
from oracle_check import digest  # noqa: E402
from zonecast.plans.registry import ORACLES, QUERIES  # noqa: E402
from zonecast.sources.roles import BASE_TABLES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_entry_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    if name not in ORACLES:
        assert len(got) > 0
        return
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)
