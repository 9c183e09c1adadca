"""M2: one row per failure with the 24 h pre-failure machine state and the
maintenance linked to it.

* M2a joins failures to the enriched readings of the same machine in
  ``[occurred_at - 24h, occurred_at)`` with the day-bucketed interval join and
  aggregates per failure (partial aggregation before the shuffle).
* M2b aggregates maintenance by ``linked_failure_id``; no time filter, so the
  minutes to the first maintenance can be negative.
* Both sides come out hash-partitioned on ``failure_id``; the final left joins
  reuse that partitioning or broadcast the small sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpulse.functions import minutes_between, round_half_up
from millpulse.operators.interval_join import window_join

LOOKBACK_HOURS = 24

_PRIOR_MEANS = [
    ("bearing_health", "avg_bearing_health_24h_prior"),
    ("lube_health", "avg_lube_health_24h_prior"),
    ("align_health", "avg_align_health_24h_prior"),
    ("motor_health", "avg_motor_health_24h_prior"),
    ("maintenance_deferral", "avg_maint_deferral_24h_prior"),
    ("demand_index", "avg_demand_24h_prior"),
    ("rush_factor", "avg_rush_24h_prior"),
]

FAILURE_COLUMNS = [
    "failure_id", "machine_id", "occurred_at", "occurrence_date", "failure_category",
    "root_cause", "severity_level", "steel_grade_active", "is_weekend",
    "load_index_at_failure", "bearing_temp_c_at_failure", "vibration_rms_at_failure",
    "motor_torque_nm_at_failure", "bearing_health_at_failure", "lube_health_at_failure",
    "align_health_at_failure", "motor_health_at_failure", "demand_index", "rush_factor",
    "maint_deferral_at_failure",
    *[name for _, name in _PRIOR_MEANS],
    "readings_that_predicted_failure", "was_predicted",
    "first_maintenance_after", "total_maint_minutes_after", "maintenance_events_after",
    "minutes_to_first_maintenance",
]


def pre_failure_state(
    failures: DataFrame,
    enriched: DataFrame,
) -> DataFrame:
    """Averages over the readings in the 24 h before each failure."""
    anchors = failures.select("failure_id", "machine_id", "occurred_at")
    points = enriched.select(
        "machine_id", "recorded_at", "recording_date", "failure_predicted_24h",
        *[src for src, _ in _PRIOR_MEANS],
    )
    pairs = window_join(
        anchors, points, ["machine_id"], "occurred_at", "recorded_at", "recording_date",
        LOOKBACK_HOURS,
    )
    return pairs.groupBy("failure_id").agg(
        *[round_half_up(F.avg(src), 4).alias(name) for src, name in _PRIOR_MEANS],
        F.count_if("failure_predicted_24h").alias("readings_that_predicted_failure"),
    )


def post_failure_maintenance(maintenance: DataFrame) -> DataFrame:
    """Maintenance linked to each failure id."""
    return (
        maintenance.where(F.col("linked_failure_id").isNotNull())
        .groupBy(F.col("linked_failure_id").alias("failure_id"))
        .agg(
            F.min("started_at").alias("first_maintenance_after"),
            F.sum("duration_minutes").alias("total_maint_minutes_after"),
            F.count(F.lit(1)).alias("maintenance_events_after"),
        )
    )


def failure_analysis(
    failures: DataFrame,
    enriched: DataFrame,
    maintenance: DataFrame,
) -> DataFrame:
    """M2: failures LEFT JOIN pre-failure state LEFT JOIN maintenance response."""
    p = pre_failure_state(failures, enriched)
    pm = post_failure_maintenance(maintenance)
    out = (
        failures.withColumnRenamed("maintenance_deferral", "maint_deferral_at_failure")
        .join(p, "failure_id", "left")
        .join(pm, "failure_id", "left")
    )
    return out.withColumns(
        {
            "was_predicted": F.col("readings_that_predicted_failure") > 0,
            "minutes_to_first_maintenance": minutes_between("first_maintenance_after", "occurred_at"),
        }
    ).select(*FAILURE_COLUMNS)
