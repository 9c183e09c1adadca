"""Dashboard aggregates (Q1-Q11) and data-test (D1-D6) semantics on small rows."""

from __future__ import annotations

import datetime as dt

from millpulse.operators import quality
from millpulse.plans import dashboard

D = dt.date


def _health(spark):
    return spark.createDataFrame(
        [
            ("M1", D(2025, 1, 1), 0.9, 0.9, "healthy"),
            ("M1", D(2025, 1, 2), 0.5, 0.7, "critical"),
            ("M2", D(2025, 1, 1), 0.7, None, "warning"),
            ("M2", D(2025, 1, 3), None, 0.65, "critical"),
        ],
        "machine_id string, recording_date date, composite_health_score double, rolling_7d_health double, "
        "health_status string",
    )


def _production(spark):
    return spark.createDataFrame(
        [
            (D(2025, 1, 1), "M1", "dom", "G1", 2, 1, 10.0, 30.0, 0.5),
            (D(2025, 1, 1), "M2", "exp", "G1", 1, 2, 5.5, 30.0, 1.0),
            (D(2025, 2, 1), "M1", "dom", "G2", 0, 0, 4.0, None, None),
        ],
        "month_date date, machine_id string, market string, steel_grade string, delayed_orders bigint, "
        "completed_orders bigint, total_tons_produced double, monthly_expected_tons double, completion_rate double",
    )


def test_forecast_taken_once_per_month(spark):
    got = {r["month_date"].month: r for r in dashboard.tons_vs_forecast(_production(spark)).collect()}
    assert got[1]["tons_produced"] == 15.5 and got[1]["expected_tons"] == 30.0
    assert got[2]["expected_tons"] is None


def test_latest_day_per_machine(spark):
    got = {r["machine_id"]: r for r in dashboard.machines_needing_action(_health(spark)).collect()}
    assert got["M1"]["latest_date"] == D(2025, 1, 2) and got["M1"]["health_status"] == "critical"
    assert got["M2"]["latest_date"] == D(2025, 1, 3) and got["M2"]["composite_health_score"] is None
    rows = dashboard.machines_needing_action(_health(spark)).collect()
    assert [r["machine_id"] for r in rows] == ["M2", "M1"]  # worst rolling health first


def test_kpis_status_counts_and_hotspots(spark):
    h, p = _health(spark), _production(spark)
    failures = spark.createDataFrame([("F1",), ("F2",)], "failure_id string")
    kpi = {r["kpi"]: r["value"] for r in dashboard.kpi_scorecards(h, failures, p).collect()}
    assert kpi == {"avg_composite_health": 0.7, "total_failures": 2.0, "avg_completion_rate": 0.75}
    dist = {(r["machine_id"], r["health_status"]): r["days"] for r in dashboard.status_distribution(h).collect()}
    assert dist[("M1", "healthy")] == 1 and dist[("M2", "critical")] == 1
    hot = {(r["steel_grade"], r["market"]): r["delay_rate"] for r in dashboard.delay_hotspots(p).collect()}
    assert hot[("G1", "dom")] == 2.0 and hot[("G2", "dom")] is None
    counts = {r["mart"]: r["row_count"] for r in dashboard.mart_row_counts({"h": h, "p": p}).collect()}
    assert counts == {"h": 4, "p": 3}


def test_slicer_bounds_inclusive_and_lists(spark):
    h = _health(spark)
    out = dashboard.slice_mart(h, "recording_date", "2025-01-01", "2025-01-02", machine_id=["M1"])
    assert out.count() == 2
    assert dashboard.slice_mart(h, "recording_date", end=D(2025, 1, 1)).count() == 2
    assert dashboard.slice_mart(h, "recording_date").count() == 4


def test_row_checks_null_passes_value_and_range_checks(spark):
    df = spark.createDataFrame(
        [("healthy", 0.0), ("broken", 1.0), (None, None), ("warning", 1.5), ("critical", -0.1)],
        "health_status string, score double",
    )
    checks = [
        ("health_status", "not_null", {}),
        ("health_status", "accepted_values", {"values": ["healthy", "warning", "critical"]}),
        ("score", "accepted_range", {"min_value": 0, "max_value": 1}),
    ]
    rep = {(r["column"], r["check"]): r for r in quality.row_checks(df, "t", checks).collect()}
    assert rep[("health_status", "not_null")]["violations"] == 1
    assert rep[("health_status", "accepted_values")]["violations"] == 1  # only 'broken'
    assert rep[("health_status", "accepted_values")]["params"] == "values=healthy|warning|critical"
    assert rep[("score", "accepted_range")]["violations"] == 2  # bounds inclusive, NULL passes
    assert rep[("score", "accepted_range")]["passed"] is False


def test_unique_counts_duplicated_values_not_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), ("c",), (None,), (None,)], "k string")
    r = quality.unique_check(df, "t", "k").first()
    assert r["violations"] == 2 and r["passed"] is False


def test_freshness_and_row_count(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1),), (dt.datetime(2025, 6, 1),)], "loaded_at timestamp")
    fresh = quality.freshness_check(df, "t", "loaded_at", "2026-07-01 00:00:00", 400).first()
    stale = quality.freshness_check(df, "t", "loaded_at", "2026-07-10 00:00:00", 400).first()
    empty = quality.freshness_check(df.limit(0), "t", "loaded_at", "2026-07-01 00:00:00", 400).first()
    assert (fresh["passed"], stale["passed"], empty["passed"]) == (True, False, False)
    rc = quality.row_count_check(df, "t", 5).first()
    assert rc["violations"] == 3 and rc["passed"] is False


def test_declared_inventory_size():
    n_models = sum(len(v) for v in quality.DECLARED_MODEL_TESTS.values())
    n_sources = sum(len(v) for v in quality.DECLARED_SOURCE_TESTS.values())
    assert (n_models, n_sources) == (36, 14)


def test_correlation_of_constant_column_is_null_not_an_error(spark):
    prod = spark.createDataFrame(
        [(0.1, 0.0, 0.2), (0.2, 0.0, 0.4), (0.3, 0.0, 0.6)], "avg_demand_index double, delay_rate double, avg_rush_factor double"
    )
    health = spark.createDataFrame(
        [(0.5, 1, 0.1)], "avg_demand_index double, readings_predicting_failure_24h bigint, avg_rush_factor double"
    )
    got = {(r["pressure"], r["outcome"]): r for r in dashboard.pressure_correlation(health, prod).collect()}
    assert got[("avg_demand_index", "delay_rate")]["correlation"] is None  # delay_rate constant
    assert got[("avg_demand_index", "readings_predicting_failure_24h")]["correlation"] is None  # one pair
    assert got[("avg_demand_index", "readings_predicting_failure_24h")]["pairs"] == 1
    both = prod.agg(dashboard.pearson("avg_demand_index", "avg_rush_factor").alias("r")).first()["r"]
    assert abs(both - 1.0) < 1e-12
