"""Every registered query equals its DuckDB oracle (small scale; the driver runs sf0.01)."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    own = set(E.llm.queries()) if E.llm else set()  # some of these can't be said in SQL
    assert set(E.queries()) - own == set(E.oracle_sql()) - own


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - set(E.llm.oracle_sql() if E.llm else ())))
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    ok, msg = compare(name, sp, dk)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["latitude", "longitude", "accident_count", "bad_weather_count", "night_count", "risk_score"]
