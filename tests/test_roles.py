"""The Spark role views and their DuckDB text give identical rows."""

from __future__ import annotations

import pytest

from millpulse.sources import roles
from millpulse.sources.roles_sql import ROLE_SQL
from tests.conftest import SF_ORACLE, compare_with_oracle


@pytest.mark.parametrize("name", ["telemetry", "failures", "maintenance", "orders", "demand"])
def test_role_view_matches_duckdb(spark, name):
    df = getattr(roles, name)(spark, SF_ORACLE)
    n = compare_with_oracle(df, ROLE_SQL[f"r_{name}"], SF_ORACLE)
    assert n > 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_declared_driver_schemas_match_files(spark, sf):
    import os

    for name, declared in roles.DECLARED.items():
        path = f"/root/testdata/{sf}/{name}.parquet"
        if os.path.exists(path):
            assert spark.read.parquet(path).schema == declared, (sf, name)
