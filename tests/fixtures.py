"""Hand-written raw rows in the plant's declared schemas (epochs in ns)."""

from __future__ import annotations

import calendar
import datetime as dt

from millpulse.sources.schemas import schema


def ns(ts: str, extra_ns: int = 0) -> int:
    d = dt.datetime.fromisoformat(ts)
    return (calendar.timegm(d.timetuple()) * 1_000_000 + d.microsecond) * 1000 + extra_ns


def raw_df(spark, name: str, rows: list[dict]):
    """DataFrame in the declared schema; columns not given are NULL."""
    sch = schema(name)
    # file reads are nullable; build the fixture the same way
    for f in sch.fields:
        f.nullable = True
    tuples = [tuple(r.get(f.name) for f in sch.fields) for r in rows]
    return spark.createDataFrame(tuples, sch)


def reading(machine: str, ts: str, **kw) -> dict:
    base = {
        "timestamp": ns(ts),
        "machine_id": machine,
        "is_running": 1,
        "is_weekend": 0,
        "label_anomaly": 0,
        "label_failure_in_24h": 0,
        "label_failure_in_72h": 0,
        "bearing_health": 0.9,
        "lube_health": 0.9,
        "align_health": 0.9,
        "motor_health": 0.9,
        "demand_index": 0.5,
        "rush_factor": 0.2,
        "maintenance_deferral": 0.1,
        "cumulative_op_hours": 10.0,
    }
    base.update(kw)
    return base


def year_files(spark, folder: str, year: int, tables: dict[str, list[dict]]) -> None:
    """Write ``{folder}/{name}_{year}.parquet`` for each given table."""
    for name, rows in tables.items():
        raw_df(spark, name, rows).coalesce(1).write.mode("overwrite").parquet(
            f"{folder}/{name}_{year}.parquet"
        )


def small_year(year: int = 2025) -> dict[str, list[dict]]:
    y = year
    telemetry = [
        reading("M1", f"{y}-03-01T00:00:00", active_order_id="O1"),
        reading("M1", f"{y}-03-01T00:10:00", active_order_id="O1", label_failure_in_24h=1),
        reading("M1", f"{y}-03-02T00:00:00", active_maintenance_id="MT1"),
        reading("M2", f"{y}-03-01T12:00:00", last_failure_id="F1"),
        reading(None, f"{y}-03-01T12:00:00"),  # dropped: null machine
        {"timestamp": None, "machine_id": "M2"},  # dropped: null timestamp
    ]
    failures = [
        {"failure_id": "F1", "machine_id": "M1", "timestamp_occurrence": ns(f"{y}-03-01T06:00:00"),
         "failure_category": "bearing", "root_cause": "wear", "severity_level": 3, "is_weekend": 2},
        {"failure_id": None, "machine_id": "M1", "timestamp_occurrence": ns(f"{y}-03-01T06:00:00")},
    ]
    maintenance = [
        {"maintenance_id": "MT1", "machine_id": "M1", "timestamp_start": ns(f"{y}-03-01T07:00:30"),
         "maint_type": "corrective", "is_planned": False, "linked_failure_id": "F1", "duration_minutes": 90},
    ]
    orders = [
        {"order_id": "O1", "timestamp_planned": ns(f"{y}-02-27T00:00:00"),
         "timestamp_start": ns(f"{y}-03-01T00:00:00"), "timestamp_end": ns(f"{y}-03-01T02:00:00"),
         "market": "domestic", "steel_grade": "S1", "total_weight_tons": 10.0,
         "machine_id_started": "M1", "duration_minutes_planned": 100.0, "is_completed": True},
        {"order_id": "O2", "timestamp_planned": None, "market": "export", "machine_id_started": "M1",
         "total_weight_tons": 5.0, "is_completed": False},
    ]
    demand = [
        {"date": dt.date(y, 3, 1), "weekday": 5, "is_weekend": 0, "trend_index": 1.0,
         "seasonal_index": 1.1, "expected_total_tons": 100.0},
        {"date": dt.date(y, 3, 2), "weekday": 6, "is_weekend": 1, "trend_index": 1.0,
         "seasonal_index": 1.2, "expected_total_tons": 50.0},
    ]
    return {
        "telemetry": telemetry,
        "failures": failures,
        "maintenance": maintenance,
        "orders": orders,
        "demand": demand,
    }
