"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check_oracle  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check_oracle.oracle_connection(SF)


@pytest.mark.parametrize("key", list(entry_points.queries()))
def test_query(spark, connection, key):
    outcome = check_oracle.compare(spark, connection, SF, key)
    assert outcome.startswith(("ok", "rows only"))


def test_entry_has_rows(spark):
    found = entry_points.entry(spark)
    assert found.columns == ["user_name"] and found.count() > 0


def test_oracles_belong_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
