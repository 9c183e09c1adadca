"""Raw role tables: the driver's test tables in the plant's *raw* file schemas.

Like ``roles`` but one step earlier: epochs are INT64 nanoseconds (with
sub-microsecond digits), flags are 0/1 integers (some 2, some NULL), ids are
strings and some keys are NULL, so cleaning (T1-T5) and staging (V1-V5) run on
the driver's data.  Every table is cast to the declared raw schema, as a
declared-schema parquet read would return it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.sources.roles import read_table
from millpulse.sources.schemas import schema

_REC = "(ts - INTERVAL 25 YEARS)"
_NS = f"(unix_micros(CAST({_REC} AS TIMESTAMP)) * 1000 + event_id % 1000)"
_CATEGORY = "CASE event_id % 3 WHEN 0 THEN 'bearing' WHEN 1 THEN 'lube' ELSE 'motor' END"
_WEEKEND = f"CASE WHEN dayofweek(CAST({_REC} AS DATE)) IN (1, 7) THEN 1 ELSE 0 END"

TELEMETRY_EXPRS = [
    f"{_NS} AS `timestamp`",
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE concat('Mill_', CAST(user_id AS STRING)) END AS machine_id",
    "event_id % 3 AS shift_id",
    "CAST(event_id % 37 AS DOUBLE) / 37 AS demand_index",
    "CAST(event_id % 13 AS DOUBLE) / 13 AS rush_factor",
    "CAST(event_id % 11 AS DOUBLE) / 11 AS maintenance_deferral",
    f"{_WEEKEND} AS is_weekend",
    "CAST(event_id % 17 AS DOUBLE) / 17 AS month_pulse_index",
    "CAST(event_id % 19 AS DOUBLE) / 19 AS trend_index",
    "event_type AS status",
    "CASE WHEN event_type = 'view' THEN NULL ELSE CAST(event_id AS STRING) END AS active_order_id",
    "concat('G', CAST(event_id % 4 AS STRING)) AS steel_grade_active",
    "value / 50 AS hardness_index_active",
    "CAST(event_id % 50 AS DOUBLE) / 50 AS load_index",
    "value / 2 + 40 AS bearing_temp_c",
    "value / 100 AS vibration_rms",
    "value * 10 AS motor_torque_nm",
    "1 - least(value, 500) / 500 AS bearing_health",
    "1 - least(value, 250) / 250 AS lube_health",
    "1 - CAST(event_id % 100 AS DOUBLE) / 200 AS align_health",
    "CASE WHEN event_type = 'error' THEN CAST(0.25 AS DOUBLE) ELSE CAST(0.75 AS DOUBLE) END AS motor_health",
    "CAST(event_id AS DOUBLE) / 6 AS cumulative_op_hours",
    "CAST(event_id % 500 AS DOUBLE) / 6 AS op_hours_since_lube",
    "CAST(event_id % 700 AS DOUBLE) / 6 AS op_hours_since_calib",
    "CAST(event_id % 900 AS DOUBLE) / 6 AS op_hours_since_bearing",
    "CAST(event_id % 1100 AS DOUBLE) / 6 AS op_hours_since_major",
    "CASE WHEN event_type = 'click' THEN CAST(event_id * 2 AS STRING) END AS active_maintenance_id",
    "CASE WHEN event_type = 'click' THEN concat('type_', CAST(event_id % 4 AS STRING)) END AS active_maintenance_type",
    "CAST(event_id - event_id % 7 AS STRING) AS last_failure_id",
    "CASE WHEN value > 200 THEN 2 WHEN value > 120 THEN 1 WHEN event_id % 89 = 0 THEN NULL ELSE 0 END AS label_anomaly",
    "CASE WHEN value > 60 THEN 1 ELSE 0 END AS label_failure_in_24h",
    "CASE WHEN value > 30 THEN 1 ELSE 0 END AS label_failure_in_72h",
    f"CASE WHEN value > 30 THEN {_CATEGORY} END AS label_failure_type_next",
    "CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS is_running",
    "value / 300 AS vib_norm",
    "value / 400 AS temp_norm",
    "(value - 50) / 25 AS vib_z",
    "(value - 40) / 20 AS temp_z",
]

FAILURES_EXPRS = [
    "CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(event_id AS STRING) END AS failure_id",
    "concat('Mill_', CAST(user_id AS STRING)) AS machine_id",
    f"{_NS} AS timestamp_occurrence",
    f"{_CATEGORY} AS failure_category",
    "CASE event_id % 4 WHEN 0 THEN 'wear' WHEN 1 THEN 'overload' ELSE 'misalignment' END AS root_cause",
    "event_id % 5 + 1 AS severity_level",
    "concat('G', CAST(event_id % 4 AS STRING)) AS steel_grade_active",
    "value / 50 AS hardness_index_active",
    "value / 100 AS load_index_at_failure",
    "value / 2 + 40 AS bearing_temp_c_at_failure",
    "value / 100 AS vibration_rms_at_failure",
    "value * 10 AS motor_torque_nm_at_failure",
    "1 - least(value, 500) / 500 AS bearing_health_at_failure",
    "1 - least(value, 250) / 250 AS lube_health_at_failure",
    "1 - CAST(event_id % 100 AS DOUBLE) / 200 AS align_health_at_failure",
    "CAST(0.25 AS DOUBLE) AS motor_health_at_failure",
    "CAST(event_id % 37 AS DOUBLE) / 37 AS demand_index",
    "CAST(event_id % 13 AS DOUBLE) / 13 AS rush_factor",
    "CAST(event_id % 11 AS DOUBLE) / 11 AS maintenance_deferral",
    f"{_WEEKEND} AS is_weekend",
    "CAST(event_id % 17 AS DOUBLE) / 17 AS month_pulse_index",
    "CAST(event_id % 19 AS DOUBLE) / 19 AS trend_index",
]

_ORDER_NS = "(unix_micros(CAST(o_orderdate AS TIMESTAMP)) * 1000)"
_START_NS = f"({_ORDER_NS} + (o_custkey % 48) * 3600000000000 + o_orderkey % 997)"

MAINTENANCE_EXPRS = [
    "CAST(o_orderkey AS STRING) AS maintenance_id",
    "CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE concat('Mill_', CAST(o_custkey % 5 AS STRING)) END AS machine_id",
    f"{_START_NS} AS timestamp_start",
    "o_orderpriority AS maint_type",
    "o_orderpriority = '5-LOW' AS is_planned",
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS STRING) END AS linked_failure_id",
    "CAST(floor(o_totalprice / 1000) AS BIGINT) AS duration_minutes",
]

ORDERS_EXPRS = [
    "CAST(o_orderkey AS STRING) AS order_id",
    f"CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE {_ORDER_NS} END AS timestamp_planned",
    f"CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {_START_NS} END AS timestamp_start",
    f"CASE WHEN o_orderstatus = 'F' THEN {_START_NS} + (o_orderkey % 500) * 60000000000 + o_custkey % 59 * 1000000000 END"
    " AS timestamp_end",
    "o_orderpriority AS market",
    "concat('G', CAST(o_orderkey % 4 AS STRING)) AS steel_grade",
    "o_totalprice / 100000 AS hardness_index",
    "o_totalprice / 10000 AS total_weight_tons",
    "CAST(o_orderkey % 37 AS DOUBLE) / 37 AS demand_index_at_intake",
    "CAST(o_orderkey % 13 AS DOUBLE) / 13 AS rush_factor_at_intake",
    "CAST(o_orderkey % 17 AS DOUBLE) / 17 AS month_pulse_index_at_intake",
    "CAST(o_orderkey % 19 AS DOUBLE) / 19 AS trend_index_at_intake",
    "CASE WHEN dayofweek(o_orderdate) IN (1, 7) THEN 1 ELSE 0 END AS is_weekend_intake",
    "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat('Mill_', CAST(o_custkey % 5 AS STRING)) END"
    " AS machine_id_started",
    "CAST(o_custkey % 400 AS DOUBLE) AS duration_minutes_planned",
    "o_orderstatus AS status",
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus = 'F' END AS is_completed",
]


def _declared(df: DataFrame, name: str) -> DataFrame:
    """Columns in declared order and types (what a declared-schema read returns)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema(name).fields])


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _declared(read_table(spark, sf_dir, "events").selectExpr(*TELEMETRY_EXPRS), "telemetry")


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").where("event_type = 'error'")
    return _declared(e.selectExpr(*FAILURES_EXPRS), "failures")


def maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _declared(read_table(spark, sf_dir, "orders").selectExpr(*MAINTENANCE_EXPRS), "maintenance")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _declared(read_table(spark, sf_dir, "orders").selectExpr(*ORDERS_EXPRS), "orders")


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    daily = li.groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(
        F.sum("l_quantity").alias("qty"),
        F.count(F.lit(1)).alias("n"),
        F.min("l_linenumber").alias("min_line"),
        F.max("l_linenumber").alias("max_line"),
    )
    out = daily.selectExpr(
        "`date`",
        "weekday(`date`) AS weekday",  # 0 = Monday
        "CASE WHEN weekday(`date`) >= 5 THEN 1 ELSE 0 END AS is_weekend",
        "CAST(n AS DOUBLE) / 24 AS trend_index",
        "CAST(min_line AS DOUBLE) / 7 AS seasonal_index",
        "CAST(max_line AS DOUBLE) / 7 AS month_pulse_index",
        "qty AS expected_total_tons",
        "CAST(min_line AS DOUBLE) / 10 AS market_split_domestic",
        "1 - CAST(min_line AS DOUBLE) / 10 AS market_split_export",
        "qty * (CAST(min_line AS DOUBLE) / 10) AS expected_domestic_tons",
        "qty * (1 - CAST(min_line AS DOUBLE) / 10) AS expected_export_tons",
    )
    return _declared(out, "demand")


RAW_ROLES = {
    "telemetry": telemetry,
    "failures": failures,
    "maintenance": maintenance,
    "orders": orders,
    "demand": demand,
}
