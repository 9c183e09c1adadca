"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from millpulse.oracle import ORACLE as ORACLES
from millpulse.plans.registry import QUERIES
from tests.conftest import SF_ORACLE, compare_with_oracle


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_ORACLE)
    compare_with_oracle(df, ORACLES[name], SF_ORACLE)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLES) <= set(entry_mod.oracle_sql())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "rolling_7d_health" in df.columns
