"""M1: daily machine health with a 7-row rolling composite score.

Plan shape: one hash aggregate on (recording_date, machine_id) with map-side
partial aggregation, so a machine holding a large share of the readings is
collapsed to one partial row per task before the shuffle; the window then runs
over the small daily table (one row per machine-day), never over raw readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millpulse.functions import health_status, round_half_up, safe_divide

ROLLING_ROWS = 7  # current day and the 6 preceding rows (rows, not calendar days)


def daily_machine_health(enriched: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per machine-day; ``extra`` adds aggregates of the readings."""
    n = F.count(F.lit(1))
    bearing, lube, align, motor = (
        F.avg("bearing_health"), F.avg("lube_health"), F.avg("align_health"), F.avg("motor_health")
    )
    return enriched.groupBy("recording_date", "machine_id").agg(
        n.alias("total_readings"),
        F.count_if("is_running").alias("running_readings"),
        F.count_if("is_anomaly").alias("anomaly_readings"),
        F.count_if("failure_predicted_24h").alias("readings_predicting_failure_24h"),
        round_half_up(safe_divide(F.count_if("is_running"), n), 4).alias("availability_rate"),
        round_half_up(safe_divide(F.count_if("is_anomaly"), n), 4).alias("anomaly_rate"),
        round_half_up(bearing, 4).alias("avg_bearing_health"),
        round_half_up(lube, 4).alias("avg_lube_health"),
        round_half_up(align, 4).alias("avg_align_health"),
        round_half_up(motor, 4).alias("avg_motor_health"),
        # composite of the unrounded component means
        round_half_up((bearing + lube + align + motor) / 4, 4).alias("composite_health_score"),
        round_half_up(F.avg("bearing_temp_c"), 2).alias("avg_bearing_temp_c"),
        round_half_up(F.avg("vibration_rms"), 4).alias("avg_vibration_rms"),
        round_half_up(F.avg("motor_torque_nm"), 2).alias("avg_motor_torque_nm"),
        round_half_up(F.avg("load_index"), 4).alias("avg_load_index"),
        F.max("cumulative_op_hours").alias("cumulative_op_hours"),
        F.max("op_hours_since_lube").alias("op_hours_since_lube"),
        F.max("op_hours_since_bearing").alias("op_hours_since_bearing"),
        F.max("op_hours_since_major").alias("op_hours_since_major"),
        round_half_up(F.avg("demand_index"), 4).alias("avg_demand_index"),
        round_half_up(F.avg("rush_factor"), 4).alias("avg_rush_factor"),
        round_half_up(F.avg("maintenance_deferral"), 4).alias("avg_maintenance_deferral"),
        round_half_up(F.avg("daily_expected_tons"), 2).alias("expected_tons_that_day"),
        F.count_if("order_is_delayed").alias("delayed_order_readings"),
        *[v.alias(k) for k, v in (extra or {}).items()],
    )


def with_status(daily: DataFrame) -> DataFrame:
    """Add ``health_status`` and the rolling mean of the (rounded) daily score."""
    w = (
        Window.partitionBy("machine_id")
        .orderBy("recording_date")
        .rowsBetween(-(ROLLING_ROWS - 1), Window.currentRow)
    )
    return daily.withColumns(
        {
            "health_status": health_status("composite_health_score"),
            "rolling_7d_health": round_half_up(F.avg("composite_health_score").over(w), 4),
        }
    )


def machine_health(enriched: DataFrame) -> DataFrame:
    return with_status(daily_machine_health(enriched))
