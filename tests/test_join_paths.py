"""Every physical path of the custom joins gives the same rows (sf0.01 roles)."""

from __future__ import annotations

import contextlib
import io

import pytest

from pyspark.sql import functions as F

from millpulse.operators.enrich import enrich
from millpulse.operators.interval_join import window_join
from millpulse.operators.joins import lookup_join
from millpulse.sources import roles
from tests.conftest import SF_ORACLE, plan_of, threshold


def window_join_plain(anchors, points, on, anchor_ts, point_ts, lookback_hours=24):
    """Brute force: every anchor against every point of its key."""
    names = {k: f"__p_{k}" for k in on}
    p = points.withColumnsRenamed(names)
    back = F.expr(f"INTERVAL {lookback_hours} HOURS")
    cond = [F.col(k) == F.col(v) for k, v in names.items()]
    cond += [F.col(point_ts) >= F.col(anchor_ts) - back, F.col(point_ts) < F.col(anchor_ts)]
    return anchors.join(p, cond, "inner").drop(*names.values())


def _same(a, b):
    a, b = sorted(map(str, a)), sorted(map(str, b))
    assert len(a) == len(b) and a == b


@pytest.fixture(scope="module")
def r(spark):
    return roles.all_roles(spark, SF_ORACLE)


@pytest.mark.parametrize("hours", [24, 72])
@pytest.mark.parametrize("limit", [-1, 10 << 20])
def test_interval_join_paths_equal_plain(spark, r, limit, hours):
    anchors = r["failures"].select("failure_id", "machine_id", "occurred_at")
    points = r["telemetry"].select("machine_id", "recorded_at", "recording_date")
    cols = ["failure_id", "machine_id", "occurred_at", "recorded_at"]
    plain = window_join_plain(anchors, points.drop("recording_date"), ["machine_id"], "occurred_at", "recorded_at", hours)
    with threshold(spark, limit):
        bucketed = window_join(anchors, points, ["machine_id"], "occurred_at", "recorded_at", "recording_date", hours)
        assert ("BroadcastHashJoin" in plan_of(bucketed)) == (limit > 0)
        _same(plain.select(cols).collect(), bucketed.select(cols).collect())


def test_lookup_join_shuffle_path_equals_broadcast(spark, r):
    t = r["telemetry"].select("machine_id", "recorded_at", "active_maintenance_id")
    m = r["maintenance"].select("maintenance_id", "is_planned")
    whole = lookup_join(t, m, "active_maintenance_id", "maintenance_id").collect()
    assert len(whole) == t.count()
    with threshold(spark, -1):
        spread = lookup_join(t, m, "active_maintenance_id", "maintenance_id", spread_by=["machine_id", "recorded_at"])
        assert "SortMergeJoin" in plan_of(spread)
        _same(whole, spread.collect())


def test_enrich_shuffle_path_equals_broadcast(spark, r):
    args = (r["telemetry"], r["orders"], r["failures"], r["maintenance"], r["demand"])
    whole = enrich(*args).collect()
    with threshold(spark, -1):
        _same(whole, enrich(*args).collect())


def test_building_a_plan_runs_no_job(spark, r):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "no job expected")
    try:
        enriched = enrich(r["telemetry"], r["orders"], r["failures"], r["maintenance"], r["demand"])
        window_join(
            r["failures"].select("failure_id", "machine_id", "occurred_at"), enriched.select("machine_id", "recorded_at", "recording_date"),
            ["machine_id"], "occurred_at", "recorded_at", "recording_date",
        )
        assert list(tracker.getJobIdsForGroup("plan-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unused_dimension_is_not_computed(spark):
    """M2 uses no forecast column, so the forecast's aggregate is not in its plan."""
    from millpulse.plans.registry import QUERIES

    assert "lineitem" not in plan_of(QUERIES["m2_failure_analysis"](spark, SF_ORACLE))


def test_wide_dimension_is_not_broadcast(spark, tmp_path):
    """The size that decides is measured from the files, not guessed from the types."""
    wide = spark.range(1500).select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(160)), lambda i: F.sha2(F.concat_ws("-", "id", i), 512)), "").alias("text"))
    wide.write.parquet(f"{tmp_path}/wide")
    spark.range(1500).select("id", (F.col("id") * 2).alias("v")).write.parquet(f"{tmp_path}/narrow")
    fact = spark.range(10).withColumnRenamed("id", "k")
    wide, narrow = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("wide", "narrow"))
    assert "BroadcastHashJoin" not in plan_of(lookup_join(fact, wide, "k", "id"))
    assert "BroadcastHashJoin" in plan_of(lookup_join(fact, narrow, "k", "id"))


def test_null_keys_spread_over_partitions(spark, r):
    """In the shuffle path the NULL-key rows hash to many reducers, not one."""
    t = r["telemetry"].select("machine_id", "recorded_at", "active_maintenance_id")
    m = r["maintenance"].select("maintenance_id", "is_planned")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = lookup_join(t, m, "active_maintenance_id", "maintenance_id", spread_by=["machine_id", "recorded_at"], null_spread=64)
        per_part = (
            out.where(F.col("active_maintenance_id").isNull())
            .groupBy(F.spark_partition_id().alias("p")).count().collect()
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_part) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_hot_key_split_by_adaptive_skew_join(spark):
    """A third of the fact rows share one key; on the shuffle path AQE splits
    that key's partition instead of giving it to one task."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(60000).select(
            F.col("id").alias("rid"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("order_fk"),
        )
        dim = spark.range(60000).select(F.col("id").alias("order_id"), (F.col("id") * 2).alias("w"))
        out = lookup_join(fact, dim, "order_fk", "order_id", spread_by=["rid"])
        rows = out.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(rows) == 60000 and sum(r["w"] for r in rows if r["order_fk"] == 7) == 20001 * 14  # ids 0, 3, 6, ... and id 7
    assert "skew=true" in buf.getvalue()
