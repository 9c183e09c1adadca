"""Views by name over the current snapshots, and the scratch folder."""

from __future__ import annotations

import datetime as dt

import pytest

from millpulse.plans.pipeline import build_models, load_year, read_raw_tables
from millpulse.operators.staging import stage_all
from millpulse.sinks import scratch
from millpulse.sinks.catalog import register
from millpulse.sinks.snapshots import SnapshotStore
from tests.conftest import plan_of
from tests.fixtures import reading, year_files
from tests.test_refresh import clean_year


def test_views_follow_loads_and_publications(spark, tmp_path):
    raw, models = f"{tmp_path}/raw", f"{tmp_path}/models"
    year_files(spark, f"{tmp_path}/src", 2025, clean_year(2025))
    load_year(spark, f"{tmp_path}/src", 2025, raw)
    with_views = register(spark, raw, models, prefix="plant_")
    try:
        assert spark.sql("SELECT * FROM plant_stg_orders").collect() == stage_all(read_raw_tables(spark, raw))["orders"].collect()
        assert spark.sql("SELECT count(*) FROM plant_telemetry WHERE load_year = 2025").first()[0] == 4
        day = spark.sql("SELECT * FROM plant_stg_telemetry WHERE recording_date = date'2025-03-02'")
        assert "PartitionFilters: [isnotnull(date" in plan_of(day) and day.count() == 1
        assert not spark.catalog.tableExists("plant_mart_machine_health")  # nothing is published yet
        build_models(spark, raw, models)
        assert spark.sql("SELECT count(*) FROM plant_mart_machine_health").first()[0] == 3
        # a reload and a rebuild are seen without registering again
        rows = clean_year(2025)
        rows["telemetry"].append(reading("M9", "2025-03-05T00:00:00"))
        year_files(spark, f"{tmp_path}/more", 2025, rows)
        load_year(spark, f"{tmp_path}/more", 2025, raw)
        assert spark.sql("SELECT max(recording_date) FROM plant_stg_telemetry").first()[0] == dt.date(2025, 3, 5)
        assert spark.sql("SELECT count(*) FROM plant_mart_machine_health").first()[0] == 3
        build_models(spark, raw, models)
        assert spark.sql("SELECT count(*) FROM plant_mart_machine_health WHERE machine_id = 'M9'").first()[0] == 1
        # commits of other applications: after a refresh
        SnapshotStore.listeners.remove(with_views._committed)
        load_year(spark, f"{tmp_path}/src", 2025, raw)
        assert spark.sql("SELECT count(*) FROM plant_telemetry").first()[0] == 5
        assert with_views.refresh()[raw] == 3 and spark.sql("SELECT count(*) FROM plant_telemetry").first()[0] == 4
    finally:
        with_views.close()
    assert not spark.catalog.tableExists("plant_stg_orders") and not spark.catalog.tableExists("plant_telemetry")


def test_views_of_stores_without_snapshots_are_empty(spark, tmp_path):
    views = register(spark, f"{tmp_path}/raw", f"{tmp_path}/models", prefix="none_")
    try:
        assert spark.sql("SELECT count(*) FROM none_stg_telemetry").first()[0] == 0
        assert not spark.catalog.tableExists("none_mart_machine_health")
    finally:
        views.close()


def test_no_machine_local_scratch_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, key, default=None):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session())
    assert scratch.scratch_root(spark, "x") != scratch.scratch_root(spark, "x")
