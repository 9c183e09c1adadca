"""Role views: the driver's test tables shaped like the staged plant tables.

The plant's own yearly files are not available to the test driver, so its
generic tables (``events``, ``orders``, ``lineitem``) are mapped onto the five
staged shapes.  Each function reads the whole table and derives columns with
built-in expressions, so the work grows with the table.  The DuckDB text of
the same views lives in ``millpulse.sources.roles_sql`` and is the oracle's
input; ``tests/test_roles.py`` checks that both give the same rows.

Mapping (events are shifted back 25 years so they overlap orders' dates):

* telemetry   <- events            one reading per event, machine = user
* failures    <- events where event_type = 'error'
* maintenance <- orders            linked_failure_id = customer key
* orders      <- orders            machine = customer key mod 5 (NULL for every 10th)
* demand      <- lineitem          one row per ship date
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()

# Stored schemas of the driver tables the role views read.
# Declaring them skips footer-based schema inference on every read;
# tests/test_roles.py checks them against the files.
DECLARED = {
    "events": _struct(
        ("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D), ("props", _S)
    ),
    "orders": _struct(
        ("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
        ("o_orderdate", _TS), ("o_orderpriority", _S),
    ),
    "lineitem": _struct(
        ("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
        ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS),
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in DECLARED:
        return spark.read.schema(DECLARED[name]).parquet(path)
    return spark.read.parquet(path)


# Spark SQL expressions of each role view (one ``selectExpr`` call per view
# keeps the Python-JVM round trips to a handful).
_REC = "ts - INTERVAL 25 YEARS"
_CATEGORY = "CASE event_id % 3 WHEN 0 THEN 'bearing' WHEN 1 THEN 'lube' ELSE 'motor' END"

TELEMETRY_EXPRS = [
    f"{_REC} AS recorded_at",
    f"CAST({_REC} AS DATE) AS recording_date",
    "concat('Mill_', CAST(user_id AS STRING)) AS machine_id",
    "event_id % 3 AS shift_id",
    "event_type AS status",
    "event_type <> 'error' AS is_running",
    f"dayofweek(CAST({_REC} AS DATE)) IN (1, 7) AS is_weekend",  # 1 = Sunday, 7 = Saturday
    "CASE WHEN event_type = 'view' THEN NULL ELSE event_id END AS active_order_id",
    "concat('G', CAST(event_id % 4 AS STRING)) AS steel_grade_active",
    "CASE WHEN event_type = 'click' THEN event_id * 2 END AS active_maintenance_id",
    "CASE WHEN event_type = 'click' THEN concat('type_', CAST(event_id % 4 AS STRING)) END AS active_maintenance_type",
    "event_id - event_id % 7 AS last_failure_id",
    "CAST(event_id % 37 AS DOUBLE) / 37 AS demand_index",
    "CAST(event_id % 13 AS DOUBLE) / 13 AS rush_factor",
    "CAST(event_id % 11 AS DOUBLE) / 11 AS maintenance_deferral",
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
    "value > 120 AS is_anomaly",
    "value > 60 AS failure_predicted_24h",
    "value > 30 AS failure_predicted_72h",
    f"CASE WHEN value > 30 THEN {_CATEGORY} END AS predicted_failure_type",
]

FAILURES_EXPRS = [
    "event_id AS failure_id",
    "concat('Mill_', CAST(user_id AS STRING)) AS machine_id",
    f"{_REC} AS occurred_at",
    f"CAST({_REC} AS DATE) AS occurrence_date",
    f"{_CATEGORY} AS failure_category",
    "CASE event_id % 4 WHEN 0 THEN 'wear' WHEN 1 THEN 'overload' ELSE 'misalignment' END AS root_cause",
    "event_id % 5 + 1 AS severity_level",
    "concat('G', CAST(event_id % 4 AS STRING)) AS steel_grade_active",
    f"dayofweek(CAST({_REC} AS DATE)) IN (1, 7) AS is_weekend",
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
]

MAINTENANCE_EXPRS = [
    "o_orderkey AS maintenance_id",
    "concat('Mill_', CAST(o_custkey % 5 AS STRING)) AS machine_id",
    "o_orderdate AS started_at",
    "CAST(o_orderdate AS DATE) AS maintenance_date",
    "o_orderpriority AS maint_type",
    "o_orderpriority = '5-LOW' AS is_planned",
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS linked_failure_id",
    "CAST(floor(o_totalprice / 1000) AS BIGINT) AS duration_minutes",
]

_VARIANCE = "CASE WHEN o_orderstatus = 'F' THEN o_custkey % 300 - o_orderkey % 300 END"

ORDERS_EXPRS = [
    "o_orderkey AS order_id",
    "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat('Mill_', CAST(o_custkey % 5 AS STRING)) END AS machine_id",
    "o_orderpriority AS market",
    "concat('G', CAST(o_orderkey % 4 AS STRING)) AS steel_grade",
    "o_totalprice / 10000 AS total_weight_tons",
    "o_orderstatus = 'F' AS is_completed",
    "o_orderdate AS planned_at",
    "CAST(o_orderdate AS DATE) AS planned_date",
    f"CAST({_VARIANCE} AS DOUBLE) AS duration_variance_minutes",
    f"{_VARIANCE} AS __variance",
    "CAST(o_orderkey % 37 AS DOUBLE) / 37 AS demand_index_at_intake",
    "CAST(o_orderkey % 13 AS DOUBLE) / 13 AS rush_factor_at_intake",
]


def _telemetry(events: DataFrame) -> DataFrame:
    return events.selectExpr(*TELEMETRY_EXPRS)


def _failures(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'error'").selectExpr(*FAILURES_EXPRS)


def _maintenance(orders_table: DataFrame) -> DataFrame:
    return orders_table.selectExpr(*MAINTENANCE_EXPRS)


def _orders(orders_table: DataFrame) -> DataFrame:
    from millpulse.operators.staging import is_delayed

    cols = [e.rsplit(" AS ", 1)[1] for e in ORDERS_EXPRS if not e.endswith("__variance")]
    o = orders_table.selectExpr(*ORDERS_EXPRS)
    with_flag = o.withColumn("is_delayed", is_delayed("__variance"))
    order = cols[:9] + ["is_delayed"] + cols[9:]
    return with_flag.select(*order)


def _demand(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy(F.col("l_shipdate").cast("date").alias("demand_date")).agg(
        F.sum("l_quantity").alias("expected_total_tons"),
        (F.count(F.lit(1)).cast("double") / 24).alias("trend_index"),
        (F.min("l_linenumber").cast("double") / 7).alias("seasonal_index"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _telemetry(read_table(spark, sf_dir, "events"))


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures(read_table(spark, sf_dir, "events"))


def maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _maintenance(read_table(spark, sf_dir, "orders"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(read_table(spark, sf_dir, "orders"))


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _demand(read_table(spark, sf_dir, "lineitem"))


def all_roles(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = read_table(spark, sf_dir, "events")
    orders_table = read_table(spark, sf_dir, "orders")
    return {
        "telemetry": _telemetry(events),
        "failures": _failures(events),
        "maintenance": _maintenance(orders_table),
        "orders": _orders(orders_table),
        "demand": _demand(read_table(spark, sf_dir, "lineitem")),
    }
