"""Declared schemas of the five raw yearly files.

Fixed values: column names, order and types of the plant's raw parquet files.
Epoch columns are INT64 nanoseconds (read as BIGINT, converted in cleaning).
Key columns are declared NOT NULL, but file reads return every column as
nullable, so the cleaning step's ``dropna`` is what enforces them.
The demand file's types other than ``date`` are not stated by the plant's
pipeline (it infers them); they are declared here as assumed.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {"BIGINT": LongType(), "STRING": StringType(), "DOUBLE": DoubleType(),
          "BOOLEAN": BooleanType(), "DATE": DateType()}

TELEMETRY_DDL = """
timestamp BIGINT NOT NULL, machine_id STRING NOT NULL, shift_id BIGINT, demand_index DOUBLE,
rush_factor DOUBLE, maintenance_deferral DOUBLE, is_weekend BIGINT, month_pulse_index DOUBLE,
trend_index DOUBLE, status STRING, active_order_id STRING, steel_grade_active STRING,
hardness_index_active DOUBLE, load_index DOUBLE, bearing_temp_c DOUBLE, vibration_rms DOUBLE,
motor_torque_nm DOUBLE, bearing_health DOUBLE, lube_health DOUBLE, align_health DOUBLE,
motor_health DOUBLE, cumulative_op_hours DOUBLE, op_hours_since_lube DOUBLE,
op_hours_since_calib DOUBLE, op_hours_since_bearing DOUBLE, op_hours_since_major DOUBLE,
active_maintenance_id STRING, active_maintenance_type STRING, last_failure_id STRING,
label_anomaly BIGINT, label_failure_in_24h BIGINT, label_failure_in_72h BIGINT,
label_failure_type_next STRING, is_running BIGINT, vib_norm DOUBLE, temp_norm DOUBLE,
vib_z DOUBLE, temp_z DOUBLE
"""

FAILURES_DDL = """
failure_id STRING NOT NULL, machine_id STRING NOT NULL, timestamp_occurrence BIGINT NOT NULL,
failure_category STRING, root_cause STRING, severity_level BIGINT, steel_grade_active STRING,
hardness_index_active DOUBLE, load_index_at_failure DOUBLE, bearing_temp_c_at_failure DOUBLE,
vibration_rms_at_failure DOUBLE, motor_torque_nm_at_failure DOUBLE,
bearing_health_at_failure DOUBLE, lube_health_at_failure DOUBLE, align_health_at_failure DOUBLE,
motor_health_at_failure DOUBLE, demand_index DOUBLE, rush_factor DOUBLE,
maintenance_deferral DOUBLE, is_weekend BIGINT, month_pulse_index DOUBLE, trend_index DOUBLE
"""

MAINTENANCE_DDL = """
maintenance_id STRING NOT NULL, machine_id STRING NOT NULL, timestamp_start BIGINT NOT NULL,
maint_type STRING, is_planned BOOLEAN, linked_failure_id STRING, duration_minutes BIGINT
"""

ORDERS_DDL = """
order_id STRING NOT NULL, timestamp_planned BIGINT, timestamp_start BIGINT, timestamp_end BIGINT,
market STRING, steel_grade STRING, hardness_index DOUBLE, total_weight_tons DOUBLE,
demand_index_at_intake DOUBLE, rush_factor_at_intake DOUBLE, month_pulse_index_at_intake DOUBLE,
trend_index_at_intake DOUBLE, is_weekend_intake BIGINT, machine_id_started STRING,
duration_minutes_planned DOUBLE, status STRING, is_completed BOOLEAN
"""

DEMAND_DDL = """
date DATE, weekday BIGINT, is_weekend BIGINT, trend_index DOUBLE, seasonal_index DOUBLE,
month_pulse_index DOUBLE, expected_total_tons DOUBLE, market_split_domestic DOUBLE,
market_split_export DOUBLE, expected_domestic_tons DOUBLE, expected_export_tons DOUBLE
"""

SOURCE_NAMES = ["telemetry", "failures", "maintenance", "orders", "demand"]

DDL = {
    "telemetry": TELEMETRY_DDL,
    "failures": FAILURES_DDL,
    "maintenance": MAINTENANCE_DDL,
    "orders": ORDERS_DDL,
    "demand": DEMAND_DDL,
}

# Key columns per source (dropped when NULL during cleaning).
KEYS = {
    "telemetry": ["timestamp", "machine_id"],
    "failures": ["failure_id", "machine_id", "timestamp_occurrence"],
    "maintenance": ["maintenance_id", "machine_id", "timestamp_start"],
    "orders": ["order_id"],
    "demand": ["date"],
}


def schema(name: str) -> StructType:
    """StructType of a declared table (built without a running session)."""
    fields = []
    for item in " ".join(DDL[name].split()).split(","):
        col, typ, *rest = item.split()
        fields.append(StructField(col, _TYPES[typ], nullable=not rest))
    return StructType(fields)
