"""V1-V5: staged views over the cleaned raw tables.

Each function takes the cleaned table (output of ``millpulse.operators.clean``)
and returns the lazily evaluated staged view: renames, DATE derivations, 0/1
flags as booleans, and the key NOT NULL guards (pushed to the scan by Catalyst).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpulse.functions import flag


def _not_null(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def is_delayed(duration_variance) -> Column:
    """Late when the actual duration exceeded the plan; unfinished orders are not late."""
    v = F.col(duration_variance) if isinstance(duration_variance, str) else duration_variance
    return F.coalesce(v > 0, F.lit(False))


def stg_telemetry(telemetry: DataFrame) -> DataFrame:
    return telemetry.where(_not_null("timestamp", "machine_id")).select(
        F.col("timestamp").alias("recorded_at"),
        F.col("date").alias("recording_date"),
        "machine_id",
        "shift_id",
        "status",
        flag("is_running").alias("is_running"),
        flag("is_weekend").alias("is_weekend"),
        "active_order_id",
        "steel_grade_active",
        "hardness_index_active",
        "active_maintenance_id",
        "active_maintenance_type",
        "last_failure_id",
        "demand_index",
        "rush_factor",
        "maintenance_deferral",
        "month_pulse_index",
        "trend_index",
        "load_index",
        "bearing_temp_c",
        "vibration_rms",
        "motor_torque_nm",
        "bearing_health",
        "lube_health",
        "align_health",
        "motor_health",
        "cumulative_op_hours",
        "op_hours_since_lube",
        "op_hours_since_calib",
        "op_hours_since_bearing",
        "op_hours_since_major",
        flag("label_anomaly").alias("is_anomaly"),
        flag("label_failure_in_24h").alias("failure_predicted_24h"),
        flag("label_failure_in_72h").alias("failure_predicted_72h"),
        F.col("label_failure_type_next").alias("predicted_failure_type"),
        "vib_norm",
        "temp_norm",
        "vib_z",
        "temp_z",
        "loaded_at",
    )


def stg_failures(failures: DataFrame) -> DataFrame:
    return failures.where(_not_null("failure_id", "machine_id", "timestamp_occurrence")).select(
        "failure_id",
        "machine_id",
        F.col("timestamp_occurrence").alias("occurred_at"),
        F.to_date("timestamp_occurrence").alias("occurrence_date"),
        "failure_category",
        "root_cause",
        "severity_level",
        "steel_grade_active",
        "hardness_index_active",
        "load_index_at_failure",
        "bearing_temp_c_at_failure",
        "vibration_rms_at_failure",
        "motor_torque_nm_at_failure",
        "bearing_health_at_failure",
        "lube_health_at_failure",
        "align_health_at_failure",
        "motor_health_at_failure",
        "demand_index",
        "rush_factor",
        "maintenance_deferral",
        flag("is_weekend").alias("is_weekend"),
        "month_pulse_index",
        "trend_index",
        "loaded_at",
    )


def stg_maintenance(maintenance: DataFrame) -> DataFrame:
    return maintenance.where(_not_null("maintenance_id", "machine_id", "timestamp_start")).select(
        "maintenance_id",
        "machine_id",
        F.col("timestamp_start").alias("started_at"),
        F.to_date("timestamp_start").alias("maintenance_date"),
        "maint_type",
        "is_planned",
        "linked_failure_id",
        "duration_minutes",
        "loaded_at",
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_id").isNotNull()).select(
        "order_id",
        F.col("machine_id_started").alias("machine_id"),
        "market",
        "steel_grade",
        "hardness_index",
        "total_weight_tons",
        "status",
        "is_completed",
        F.col("timestamp_planned").alias("planned_at"),
        F.col("timestamp_start").alias("started_at"),
        F.col("timestamp_end").alias("ended_at"),
        F.to_date("timestamp_planned").alias("planned_date"),
        F.to_date("timestamp_start").alias("start_date"),
        "duration_minutes_planned",
        "actual_duration_minutes",
        "duration_variance_minutes",
        is_delayed("duration_variance_minutes").alias("is_delayed"),
        "demand_index_at_intake",
        "rush_factor_at_intake",
        "month_pulse_index_at_intake",
        "trend_index_at_intake",
        flag("is_weekend_intake").alias("is_weekend_intake"),
        "loaded_at",
    )


def stg_demand(demand: DataFrame) -> DataFrame:
    return demand.where(F.col("date").isNotNull()).select(
        F.col("date").alias("demand_date"),
        "weekday",
        flag("is_weekend").alias("is_weekend"),
        "trend_index",
        "seasonal_index",
        "month_pulse_index",
        "expected_total_tons",
        "market_split_domestic",
        "market_split_export",
        "expected_domestic_tons",
        "expected_export_tons",
        "loaded_at",
    )


STAGERS = {
    "telemetry": stg_telemetry,
    "failures": stg_failures,
    "maintenance": stg_maintenance,
    "orders": stg_orders,
    "demand": stg_demand,
}


def stage_all(clean: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: STAGERS[name](df) for name, df in clean.items()}
