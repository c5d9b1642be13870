from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from homestrata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session("tests", cores=4, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture
def value(spark):
    """Evaluate a column over one row of named string (or given) values."""

    def run(column, **row):
        rows = [tuple(row.values())] if row else [(0,)]
        names = list(row) or ["_"]
        schema = ", ".join(f"`{n}` {_kind(v)}" for n, v in zip(names, rows[0]))
        return spark.createDataFrame(rows, schema).select(column.alias("v")).first()[0]

    return run


def _kind(v):
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, int):
        return "bigint"
    if isinstance(v, float):
        return "double"
    if isinstance(v, list):
        return "array<string>"
    return "string"
