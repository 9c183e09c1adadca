"""Declarative data tests as Spark aggregations.

Every check returns rows ``(table, column, check, params, violations, passed)``.
All NOT NULL / accepted-values / range checks of one table run in a single
aggregate pass (one scan, partial aggregation); a uniqueness check is a grouped
count (map-side combined, so a hot duplicated key costs one partial row per task)
that carries the other checks' counts along, so the table is still read once.
Nothing is collected: the report is itself a DataFrame.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The declared tests of the plant models and sources.
# model -> list of (column, check, params)
DECLARED_MODEL_TESTS: dict[str, list[tuple[str, str, dict]]] = {
    "stg_telemetry": [
        ("recorded_at", "not_null", {}),
        ("machine_id", "not_null", {}),
        ("is_anomaly", "not_null", {}),
        ("failure_predicted_24h", "not_null", {}),
    ],
    "stg_failures": [
        ("failure_id", "not_null", {}),
        ("failure_id", "unique", {}),
        ("machine_id", "not_null", {}),
        ("occurred_at", "not_null", {}),
    ],
    "stg_maintenance": [
        ("maintenance_id", "not_null", {}),
        ("maintenance_id", "unique", {}),
        ("machine_id", "not_null", {}),
        ("is_planned", "not_null", {}),
    ],
    "stg_orders": [
        ("order_id", "not_null", {}),
        ("order_id", "unique", {}),
        ("is_delayed", "not_null", {}),
    ],
    "stg_demand": [
        ("demand_date", "not_null", {}),
        ("demand_date", "unique", {}),
        ("expected_total_tons", "not_null", {}),
    ],
    "int_telemetry_enriched": [
        ("recorded_at", "not_null", {}),
        ("machine_id", "not_null", {}),
        ("is_anomaly", "not_null", {}),
    ],
    "mart_machine_health": [
        ("recording_date", "not_null", {}),
        ("machine_id", "not_null", {}),
        ("composite_health_score", "not_null", {}),
        ("composite_health_score", "accepted_range", {"min_value": 0, "max_value": 1}),
        ("health_status", "not_null", {}),
        ("health_status", "accepted_values", {"values": ["healthy", "warning", "critical"]}),
        ("availability_rate", "accepted_range", {"min_value": 0, "max_value": 1}),
    ],
    "mart_failure_analysis": [
        ("failure_id", "not_null", {}),
        ("failure_id", "unique", {}),
        ("machine_id", "not_null", {}),
        ("was_predicted", "not_null", {}),
    ],
    "mart_production_performance": [
        ("month_date", "not_null", {}),
        ("machine_id", "not_null", {}),
        ("completion_rate", "accepted_range", {"min_value": 0, "max_value": 1}),
        ("delay_rate", "accepted_range", {"min_value": 0, "max_value": 1}),
    ],
}

DECLARED_SOURCE_TESTS: dict[str, list[tuple[str, str, dict]]] = {
    "telemetry": [
        ("timestamp", "not_null", {}),
        ("machine_id", "not_null", {}),
        ("label_anomaly", "not_null", {}),
    ],
    "failures": [
        ("failure_id", "not_null", {}),
        ("failure_id", "unique", {}),
        ("machine_id", "not_null", {}),
        ("timestamp_occurrence", "not_null", {}),
    ],
    "maintenance": [
        ("maintenance_id", "not_null", {}),
        ("maintenance_id", "unique", {}),
        ("machine_id", "not_null", {}),
    ],
    "orders": [("order_id", "not_null", {}), ("order_id", "unique", {})],
    "demand": [("date", "not_null", {}), ("date", "unique", {})],
}

# Source freshness: telemetry's load stamp may be at most this many days old.
FRESHNESS = {"telemetry": ("loaded_at", 400)}

# Documented source sizes for one year (not asserted by the plant's runner).
EXPECTED_ROWS = {"telemetry": 262800, "failures": 139, "maintenance": 552, "orders": 31324, "demand": 365}


def _params(params: dict) -> str:
    if not params:
        return ""
    def fmt(v):
        return "|".join(str(x) for x in v) if isinstance(v, (list, tuple)) else str(v)

    return ";".join(f"{k}={fmt(params[k])}" for k in sorted(params))


def _violation_expr(column: str, check: str, params: dict) -> Column:
    c = F.col(column)
    if check == "not_null":
        return F.count_if(c.isNull())
    if check == "accepted_values":
        return F.count_if(~c.isin(*params["values"]))  # NULL passes
    if check == "accepted_range":
        return F.count_if(~c.between(params["min_value"], params["max_value"]))  # NULL passes
    raise ValueError(f"not a row-level check: {check}")


def violations(check: tuple[str, str, dict]) -> Column:
    """The number of violations of a row-level check, as an aggregate."""
    return _violation_expr(*check)


def check_metrics(checks: list[tuple[str, str, dict]]) -> dict[str, Column]:
    """The row-level checks as aggregates to observe while the table is written."""
    return {f"check.{column}.{check}": _violation_expr(column, check, params) for column, check, params in checks if check != "unique"}


def observed_checks(spark: SparkSession, table: str, checks: list[tuple[str, str, dict]], batches: list[dict]) -> DataFrame | None:
    """Report of the row-level checks from what was observed at the writes of ``batches``.

    None where a batch lacks a count.
    """
    rows = []
    for column, check, params in checks:
        if check == "unique":
            continue
        counts = [b.get(f"check.{column}.{check}") for b in batches]
        if any(c is None for c in counts):
            return None
        rows.append((table, column, check, _params(params), sum(counts), sum(counts) == 0))
    return spark.createDataFrame(rows, "table string, column string, check string, params string, violations bigint, passed boolean")


def _report(table: str, rows: DataFrame) -> DataFrame:
    """``rows`` has column, check, params, violations -> full report shape."""
    return rows.select(
        F.lit(table).alias("table"),
        "column",
        "check",
        "params",
        F.col("violations").cast("bigint").alias("violations"),
        (F.col("violations") == 0).alias("passed"),
    )


Check = tuple[str, str, dict]


def aggregate_checks(df: DataFrame, checks: list[tuple[str, Check, Column]]) -> DataFrame:
    """Report rows of (table, check, violations as an aggregate over ``df``), in one pass."""
    rows = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(column).alias("column"),
            F.lit(check).alias("check"),
            F.lit(_params(params)).alias("params"),
            violations.cast("bigint").alias("violations"),
        )
        for table, (column, check, params), violations in checks
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows")).withColumn("passed", F.col("violations") == 0)


def row_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """D1/D3/D4 for one table in one aggregate pass, one row per check."""
    return aggregate_checks(df, [(table, c, _violation_expr(*c)) for c in checks])


def unique_check(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    dup = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    rows = dup.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(column).alias("column"), F.lit("unique").alias("check"), F.lit("").alias("params"), "violations"
    )
    return _report(table, rows)


def freshness_check(
    df: DataFrame, table: str, field: str, as_of: dt.datetime | str, error_after_days: int
) -> DataFrame:
    """Violation when ``max(field)`` is older than ``as_of - error_after_days``
    (or the table is empty).  ``as_of`` is a UTC wall-clock string or a
    datetime (naive ones are taken as UTC)."""
    if isinstance(as_of, dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
        as_of = as_of.isoformat(sep=" ")
    as_of_col = F.lit(as_of).cast("timestamp")  # parsed in the session zone (UTC)
    latest = df.agg(F.max(F.col(field).cast("timestamp")).alias("latest"))
    stale = F.coalesce(
        F.col("latest") < as_of_col - F.make_dt_interval(F.lit(error_after_days)), F.lit(True)
    )
    rows = latest.select(
        F.lit(field).alias("column"),
        F.lit("freshness").alias("check"),
        F.lit(_params({"error_after_days": error_after_days, "as_of": str(as_of)})).alias("params"),
        F.when(stale, 1).otherwise(0).alias("violations"),
    )
    return _report(table, rows)


def row_count_check(df: DataFrame, table: str, expected: int) -> DataFrame:
    """Absolute difference between the row count and the documented count."""
    rows = df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("*").alias("column"),
        F.lit("row_count").alias("check"),
        F.lit(_params({"expected": expected})).alias("params"),
        F.abs(F.col("n") - F.lit(expected)).alias("violations"),
    )
    return _report(table, rows)


def _checks_by_key(df: DataFrame, table: str, checks: list[Check], key: str) -> DataFrame:
    """Row-level checks and the uniqueness of ``key`` from one pass: violations are counted for each key, then summed."""
    row_level = [c for c in checks if c[1] != "unique"]
    counts = [violations(c).alias(f"__check_{i}") for i, c in enumerate(row_level)]
    keyed = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"), *counts)
    parts = [(table, c, F.coalesce(F.sum(f"__check_{i}"), F.lit(0))) for i, c in enumerate(row_level)]
    parts.append((table, (key, "unique", {}), F.count_if((F.col("__rows") > 1) & F.col("__key").isNotNull())))
    return aggregate_checks(keyed, parts)


def run_checks(df: DataFrame, table: str, checks: list[tuple[str, str, dict]]) -> DataFrame:
    """All declared checks of one table: one pass, and one more for each further unique column."""
    row_level = [c for c in checks if c[1] != "unique"]
    unique = [column for column, check, _ in checks if check == "unique"]
    parts = []
    if row_level and unique:
        parts.append(_checks_by_key(df, table, row_level, unique.pop(0)))
    elif row_level:
        parts.append(row_checks(df, table, row_level))
    parts += [unique_check(df, table, column) for column in unique]
    return reduce(DataFrame.unionByName, parts)


def run_declared(tables, declared=None) -> DataFrame:
    """Report for every declared test (``tables`` maps names to DataFrames).

    A table that has declared tests and is not given raises: a report that lacks
    it would read as passed.
    """
    declared = DECLARED_MODEL_TESTS if declared is None else declared
    missing = [name for name in declared if name not in tables]
    if missing:
        raise KeyError(f"declared tests without their table: {', '.join(missing)}")
    parts = [run_checks(tables[name], name, checks) for name, checks in declared.items()]
    return reduce(DataFrame.unionByName, parts)
