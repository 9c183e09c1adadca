"""Enriched telemetry, one row per reading with order, failure,
maintenance and demand context (J1-J4, left joins on the foreign keys the
readings carry)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpulse.operators.joins import lookup_join

# Output contract: 44 columns in this order.
ENRICHED_COLUMNS = [
    # telemetry core
    "recorded_at", "recording_date", "machine_id", "shift_id", "status", "is_running",
    "is_weekend", "is_anomaly", "failure_predicted_24h", "failure_predicted_72h",
    "predicted_failure_type",
    # sensors
    "bearing_temp_c", "vibration_rms", "motor_torque_nm", "load_index",
    "bearing_health", "lube_health", "align_health", "motor_health",
    # operating hours
    "cumulative_op_hours", "op_hours_since_lube", "op_hours_since_calib",
    "op_hours_since_bearing", "op_hours_since_major",
    # operational pressure
    "demand_index", "rush_factor", "maintenance_deferral",
    # active order
    "active_order_id", "order_market", "order_steel_grade", "order_weight_tons",
    "order_is_completed", "order_is_delayed", "order_duration_variance_min",
    # last failure
    "last_failure_id", "failure_category", "failure_root_cause", "failure_severity",
    # active maintenance
    "active_maintenance_id", "active_maintenance_type", "maint_is_planned",
    "maint_duration_minutes",
    # daily demand
    "daily_expected_tons", "daily_seasonal_index",
]

# Fact rows with a NULL key are spread by the reading's identity.
_SPREAD_BY = ["machine_id", "recorded_at"]


def enrich(
    telemetry: DataFrame,
    orders: DataFrame,
    failures: DataFrame,
    maintenance: DataFrame,
    demand: DataFrame,
) -> DataFrame:
    """Join staged orders, failures, maintenance and demand onto staged telemetry."""
    o = orders.select(
        "order_id",
        F.col("market").alias("order_market"),
        F.col("steel_grade").alias("order_steel_grade"),
        F.col("total_weight_tons").alias("order_weight_tons"),
        F.col("is_completed").alias("order_is_completed"),
        F.col("is_delayed").alias("order_is_delayed"),
        F.col("duration_variance_minutes").alias("order_duration_variance_min"),
    )
    f = failures.select(
        "failure_id",
        "failure_category",
        F.col("root_cause").alias("failure_root_cause"),
        F.col("severity_level").alias("failure_severity"),
    )
    m = maintenance.select(
        "maintenance_id",
        F.col("is_planned").alias("maint_is_planned"),
        F.col("duration_minutes").alias("maint_duration_minutes"),
    )
    d = demand.select(
        "demand_date",
        F.col("expected_total_tons").alias("daily_expected_tons"),
        F.col("seasonal_index").alias("daily_seasonal_index"),
    )
    t = telemetry
    for dim, fact_key, dim_key in [
        (d, "recording_date", "demand_date"),
        (f, "last_failure_id", "failure_id"),
        (m, "active_maintenance_id", "maintenance_id"),
        (o, "active_order_id", "order_id"),
    ]:
        t = lookup_join(t, dim, fact_key, dim_key, spread_by=_SPREAD_BY)
    return t.select(*ENRICHED_COLUMNS)
