"""Mart semantics on hand-written staged rows (FIXTURES edge cases)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millpulse.operators import quality
from millpulse.operators.enrich import ENRICHED_COLUMNS, enrich
from millpulse.plans.failures import failure_analysis
from millpulse.plans.health import daily_machine_health, machine_health, with_status
from millpulse.plans.production import production_performance
from tests.conftest import plan_of, threshold

D = dt.date
TS = dt.datetime


def _stored(df, path):
    """The rows as a table: joins are chosen by the measured size of files."""
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def _daily(spark, rows):
    return spark.createDataFrame(rows, "machine_id string, recording_date date, composite_health_score double")


def test_status_thresholds_and_null_is_critical(spark):
    df = _daily(spark, [("a", D(2025, 1, 1), 0.80), ("a", D(2025, 1, 2), 0.60), ("a", D(2025, 1, 3), None),
                        ("a", D(2025, 1, 4), 0.5999)])
    got = {r["recording_date"].day: r["health_status"] for r in with_status(df).collect()}
    assert got == {1: "healthy", 2: "warning", 3: "critical", 4: "critical"}


def test_rolling_counts_rows_not_days(spark):
    # 8 readings days spread over 30 calendar days: the frame on the last row covers rows 2..8
    days = [1, 2, 5, 9, 14, 20, 25, 30]
    df = _daily(spark, [("a", D(2025, 1, d), float(i)) for i, d in enumerate(days)])
    last = with_status(df).where(F.col("recording_date") == D(2025, 1, 30)).first()
    assert last["rolling_7d_health"] == pytest.approx(sum(range(1, 8)) / 7, abs=1e-4)
    first = with_status(df).where(F.col("recording_date") == D(2025, 1, 1)).first()
    assert first["rolling_7d_health"] == 0.0


def test_rounding_half_away_from_zero(spark):
    from millpulse.functions import round_half_up

    import math

    df = spark.createDataFrame(
        [(1.005,), (-1.005,), (2.5,), (0.12345,), (None,), (float("nan"),), (float("inf"),), (1e30,)], "x double"
    )
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got[:5] == [1.01, -1.01, 2.5, 0.12, None]
    assert math.isnan(got[5]) and got[6] == float("inf") and got[7] == 1e30


def _staged(spark):
    tel = spark.createDataFrame(
        [
            # exactly 24 h before the failure: inside the window
            ("M1", TS(2025, 3, 1, 6, 0), True, 0.5),
            ("M1", TS(2025, 3, 1, 23, 0), False, 0.7),
            # at the failure instant: outside
            ("M1", TS(2025, 3, 2, 6, 0), True, 0.1),
            ("M2", TS(2025, 3, 2, 5, 0), True, 0.9),
        ],
        "machine_id string, recorded_at timestamp, failure_predicted_24h boolean, bearing_health double",
    )
    for c in ENRICHED_COLUMNS:
        if c not in tel.columns:
            tel = tel.withColumn(c, F.lit(None).cast("double"))
    tel = tel.withColumn("recording_date", F.to_date("recorded_at"))
    failures = spark.createDataFrame(
        [("F1", "M1", TS(2025, 3, 2, 6, 0), 0.3), ("F2", "M3", TS(2025, 3, 2, 6, 0), 0.3)],
        "failure_id string, machine_id string, occurred_at timestamp, maintenance_deferral double",
    )
    for c in ["occurrence_date", "failure_category", "root_cause", "severity_level", "steel_grade_active",
              "is_weekend", "load_index_at_failure", "bearing_temp_c_at_failure", "vibration_rms_at_failure",
              "motor_torque_nm_at_failure", "bearing_health_at_failure", "lube_health_at_failure",
              "align_health_at_failure", "motor_health_at_failure", "demand_index", "rush_factor"]:
        failures = failures.withColumn(c, F.lit(None).cast("string"))
    maint = spark.createDataFrame(
        [("MT1", TS(2025, 3, 2, 5, 0, 30), "F1", 30), ("MT2", TS(2025, 3, 3, 0, 0), "F1", 15), ("MT3", TS(2025, 3, 3), None, 5)],
        "maintenance_id string, started_at timestamp, linked_failure_id string, duration_minutes bigint",
    )
    return tel.select(*ENRICHED_COLUMNS), failures, maint


@pytest.mark.parametrize(("max_bytes", "joins"), [(64 << 20, "BroadcastHashJoin"), (-1, "SortMergeJoin")])
def test_failure_window_and_maintenance(spark, tmp_path, max_bytes, joins):
    tel, failures, maint = (_stored(df, tmp_path / str(i)) for i, df in enumerate(_staged(spark)))
    with threshold(spark, max_bytes):
        mart = failure_analysis(failures, tel, maint)
        assert joins in plan_of(mart)
        out = {r["failure_id"]: r for r in mart.collect()}
    f1 = out["F1"]
    assert f1["avg_bearing_health_24h_prior"] == 0.6  # (0.5 + 0.7) / 2; the reading at the instant is out
    assert f1["readings_that_predicted_failure"] == 1
    assert f1["was_predicted"] is True
    # linked maintenance before the failure: negative, truncated toward zero (-59.5 min -> -59)
    assert f1["minutes_to_first_maintenance"] == -59
    assert f1["maintenance_events_after"] == 2 and f1["total_maint_minutes_after"] == 45
    f2 = out["F2"]
    assert f2["readings_that_predicted_failure"] is None and f2["was_predicted"] is None
    report = quality.row_checks(
        failure_analysis(failures, tel, maint), "mart_failure_analysis", [("was_predicted", "not_null", {})]
    ).first()
    assert report["violations"] == 1 and report["passed"] is False


def _orders(spark, rows):
    return spark.createDataFrame(
        rows,
        "order_id string, machine_id string, market string, steel_grade string, planned_date date, "
        "is_completed boolean, is_delayed boolean, total_weight_tons double, duration_variance_minutes double, "
        "demand_index_at_intake double, rush_factor_at_intake double",
    )


def test_production_edge_cases(spark):
    orders = _orders(
        spark,
        [
            ("a", "M1", "dom", "G", D(2025, 1, 5), False, False, 4.0, None, 0.1, 0.1),
            ("b", "M1", "dom", "G", D(2025, 1, 6), None, False, 6.0, None, 0.1, 0.1),
            ("c", "M2", "exp", "G", D(2025, 2, 6), True, True, 3.0, 5.0, 0.1, 0.1),
            ("d", None, "exp", "G", D(2025, 2, 6), True, True, 3.0, 5.0, 0.1, 0.1),
        ],
    )
    demand = spark.createDataFrame(
        [(D(2025, 2, 1), 10.0, 1.0, 1.0), (D(2025, 2, 2), 20.0, 1.0, 1.0)],
        "demand_date date, expected_total_tons double, trend_index double, seasonal_index double",
    )
    out = {r["month_date"].month: r for r in production_performance(orders, demand).collect()}
    jan, feb = out[1], out[2]
    assert jan["delay_rate"] is None  # no completed order
    assert jan["completed_orders"] == 0 and jan["incomplete_orders"] == 1 and jan["total_orders"] == 2
    assert jan["total_tons_produced"] == 10.0
    assert jan["monthly_expected_tons"] is None and jan["production_vs_forecast_ratio"] is None
    assert feb["monthly_expected_tons"] == 30.0 and feb["production_vs_forecast_ratio"] == 0.1
    assert len(out) == 2  # the order without a machine is not counted


def test_duplicate_key_fans_out_and_is_reported(spark, tmp_path):
    tel = spark.createDataFrame([("M1", TS(2025, 1, 1), 7)], "machine_id string, recorded_at timestamp, active_order_id int")
    from_dims = {"order_market", "order_steel_grade", "order_weight_tons", "order_is_completed", "order_is_delayed",
                 "order_duration_variance_min", "failure_category", "failure_root_cause", "failure_severity",
                 "maint_is_planned", "maint_duration_minutes", "daily_expected_tons", "daily_seasonal_index"}
    for c in ENRICHED_COLUMNS:
        if c not in tel.columns and c not in from_dims:
            tel = tel.withColumn(c, F.lit(None).cast("string"))
    tel = tel.withColumn("recording_date", F.to_date("recorded_at")).withColumn("last_failure_id", F.lit(None).cast("int"))
    tel = tel.withColumn("active_maintenance_id", F.lit(None).cast("int"))
    orders = spark.createDataFrame(
        [(7, "x"), (7, "y")], "order_id int, market string"
    ).selectExpr("*", "'G' as steel_grade", "1.0 as total_weight_tons", "true as is_completed",
                 "false as is_delayed", "0.0 as duration_variance_minutes")
    empty_f = spark.createDataFrame([], "failure_id int, failure_category string, root_cause string, severity_level int")
    empty_m = spark.createDataFrame([], "maintenance_id int, is_planned boolean, duration_minutes bigint")
    empty_d = spark.createDataFrame([], "demand_date date, expected_total_tons double, seasonal_index double")
    tel, orders = _stored(tel, tmp_path / "telemetry"), _stored(orders, tmp_path / "orders")
    for max_bytes, joins in ((64 << 20, "BroadcastHashJoin"), (-1, "SortMergeJoin")):
        with threshold(spark, max_bytes):
            e = enrich(tel, orders, empty_f, empty_m, empty_d)
            assert joins in plan_of(e)
            assert e.count() == 2
    report = quality.unique_check(orders, "stg_orders", "order_id").first()
    assert report["violations"] == 1 and report["passed"] is False
