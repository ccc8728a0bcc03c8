"""The queries that SQL expresses, against DuckDB on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from oracle_check import compare, duck  # noqa: E402

from strata.llm.queries import oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    ok, message = compare(name, queries()[name](spark, SF).toPandas(), duck(SF).execute(oracle_sql()[name]).df())
    assert ok, message
