"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry_module  # noqa: E402
from check import compare, connect  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    state, rows, _, note = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert state in ("ok", "rows-only"), note


def test_entry(spark):
    df = entry_module.entry(spark)
    assert "city_discount_pct" in df.columns and df.count() > 0
