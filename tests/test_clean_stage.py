"""T1-T5 and V1-V5 on hand-written raw rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millpulse.functions import ns_to_timestamp
from millpulse.operators import clean, staging
from tests.fixtures import ns, raw_df, reading, small_year


def test_null_keys_dropped(spark):
    rows = small_year()
    t = clean.CLEANERS["telemetry"](raw_df(spark, "telemetry", rows["telemetry"]))
    assert t.count() == 4
    f = clean.CLEANERS["failures"](raw_df(spark, "failures", rows["failures"]))
    assert f.count() == 1


def test_ns_conversion_is_exact(spark):
    vals = [ns("2025-06-30T23:59:59.999999", 999), ns("2025-01-01T00:00:00.000001", 1), ns("2025-03-01T12:34:56.123456", 500)]
    df = spark.createDataFrame([(v,) for v in vals], "v bigint")
    got = [r[0] for r in df.select(ns_to_timestamp("v").cast("timestamp_ntz")).collect()]
    assert got == [
        dt.datetime(2025, 6, 30, 23, 59, 59, 999999),
        dt.datetime(2025, 1, 1, 0, 0, 0, 1),
        dt.datetime(2025, 3, 1, 12, 34, 56, 123456),
    ]


def test_flags_any_nonzero_is_true(spark):
    t = clean.CLEANERS["telemetry"](
        raw_df(spark, "telemetry", [reading("M", "2025-01-01T00:00:00", label_anomaly=2, is_running=0, is_weekend=None)])
    )
    r = t.first()
    assert r["is_anomaly"] is True and r["is_running"] is False and r["is_weekend"] is None
    assert r["date"] == dt.date(2025, 1, 1)


def test_orders_durations_and_delay(spark):
    base = {"timestamp_planned": ns("2025-01-01T00:00:00"), "timestamp_start": ns("2025-01-01T00:00:00")}
    rows = [
        dict(base, order_id="null_end", duration_minutes_planned=10.0),
        dict(base, order_id="zero", timestamp_end=ns("2025-01-01T00:10:00"), duration_minutes_planned=10.0),
        dict(base, order_id="plus", timestamp_end=ns("2025-01-01T00:11:00"), duration_minutes_planned=10.0),
        dict(base, order_id="minus", timestamp_end=ns("2025-01-01T00:09:00"), duration_minutes_planned=10.0),
        dict(base, order_id="secs", timestamp_end=ns("2025-01-01T00:00:59.900"), duration_minutes_planned=0.0),
    ]
    o = staging.stg_orders(clean.CLEANERS["orders"](raw_df(spark, "orders", rows)))
    got = {r["order_id"]: r for r in o.collect()}
    assert got["null_end"]["actual_duration_minutes"] is None
    assert got["null_end"]["duration_variance_minutes"] is None
    assert got["null_end"]["is_delayed"] is False
    assert got["zero"]["is_delayed"] is False
    assert got["plus"]["is_delayed"] is True
    assert got["minus"]["is_delayed"] is False
    # whole seconds, then divided as double
    assert got["secs"]["actual_duration_minutes"] == pytest.approx(59 / 60)


def test_orders_year_from_planned_date(spark):
    rows = [{"order_id": "a", "timestamp_planned": None}, {"order_id": "b", "timestamp_planned": ns("2024-12-31T23:00:00")}]
    o = clean.CLEANERS["orders"](raw_df(spark, "orders", rows)).select("order_id", "year").collect()
    assert {r[0]: r[1] for r in o} == {"a": None, "b": 2024}


def test_year_guard_is_optional_and_covers_every_table(spark):
    us = ns("2025-05-01T00:00:00") // 1000  # a file written in microseconds
    df = raw_df(spark, "telemetry", [reading("M", "2025-05-01T00:00:00", timestamp=us)])
    assert clean.clean(df, "telemetry").count() == 1
    with pytest.raises(Exception, match="timestamp outside 2024-2026"):
        clean.clean(df, "telemetry", (2024, 2026)).collect()
    for name, rows in small_year().items():
        table = clean.clean(raw_df(spark, name, rows), name, (2025, 2025))
        assert table.count() == clean.clean(raw_df(spark, name, rows), name).count()
        with pytest.raises(Exception, match="outside 2030-2031"):
            clean.clean(raw_df(spark, name, rows), name, (2030, 2031)).collect()


def test_year_metrics(spark):
    rows = [{"order_id": "a", "timestamp_planned": ns("2027-01-01T00:00:00")}, {"order_id": "b", "timestamp_planned": ns("2025-01-01T00:00:00")}]
    metrics = clean.year_metrics("orders", 2024, 2026)
    got = clean.clean(raw_df(spark, "orders", rows), "orders").agg(*[c.alias(k) for k, c in metrics.items()]).first().asDict()
    assert {k: v for k, v in got.items() if v} == {"values.timestamp_planned": 2, "outside.timestamp_planned": 1}
    assert set(got) == {f"{k}.{c}" for k in ("values", "outside") for c in ("timestamp_planned", "timestamp_start", "timestamp_end")}


def test_staged_column_counts(spark):
    rows = small_year()
    expected = {"telemetry": 40, "failures": 24, "maintenance": 9, "orders": 23, "demand": 12}
    for name, n in expected.items():
        c = clean.CLEANERS[name](raw_df(spark, name, rows[name]))
        assert len(staging.STAGERS[name](c).columns) == n, name


def test_staging_renames(spark):
    rows = small_year()
    t = staging.stg_telemetry(clean.CLEANERS["telemetry"](raw_df(spark, "telemetry", rows["telemetry"])))
    assert {"recorded_at", "recording_date", "failure_predicted_24h", "predicted_failure_type"} <= set(t.columns)
    d = staging.stg_demand(clean.CLEANERS["demand"](raw_df(spark, "demand", rows["demand"])))
    assert d.columns[0] == "demand_date"
    assert d.where(F.col("is_weekend")).count() == 1
