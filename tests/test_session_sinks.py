"""Session helpers and the physical organisation of writes."""

from __future__ import annotations

import contextlib
import io

from millpulse.sinks.tables import organize


def test_organize_rebalances_and_clusters(spark):
    df = spark.range(1000).selectExpr("id", "date_add(date'2025-01-01', cast(id % 5 as int)) as d", "id % 7 as m")
    out = organize(df, ["d"], ["m"], ["d"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert "Sort [d#" in plan and "m#" in plan.split("Sort [d#", 1)[1].split("\n", 1)[0]
    assert out.count() == 1000


def test_even_rebalance_has_no_constant_key(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        organize(spark.range(10).selectExpr("id", "2025 as load_year"), ["load_year"]).explain()
    assert "RoundRobinPartitioning" in buf.getvalue() and "hashpartitioning(2025" not in buf.getvalue()
