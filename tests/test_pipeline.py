"""S3/S4, K1-K4, K9, T6 and the model build on written yearly files."""

from __future__ import annotations

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from millpulse.plans import pipeline
from millpulse.plans.pipeline import adopt_table, build_models, clean_schema, load_year, read_models, read_raw_tables, run_year
from millpulse.sinks.snapshots import SnapshotStore
from millpulse.sinks.tables import LayoutError, replace_days, table_layout
from millpulse.sources.files import SourceError, check_sources, year_path
from tests.fixtures import ns, raw_df, small_year, year_files


@pytest.fixture()
def work():
    return tempfile.mkdtemp(prefix="millpulse-test-")


def stored(spark, raw_root, name):
    return read_raw_tables(spark, raw_root)[name]


def test_year_path():
    assert year_path("gs://b/raw/", "orders", 2025) == "gs://b/raw/orders_2025.parquet"


def test_missing_sources_all_listed(spark, work):
    rows = small_year()
    year_files(spark, work, 2025, {k: rows[k] for k in ("telemetry", "orders", "demand")})
    with pytest.raises(SourceError) as exc:
        check_sources(spark, work, 2025)
    msg = str(exc.value)
    assert "failures_2025" in msg and "maintenance_2025" in msg and "orders_2025" not in msg


def test_missing_column_reported(spark, work):
    rows = small_year()
    year_files(spark, work, 2025, rows)
    raw_df(spark, "demand", rows["demand"]).drop("weekday").write.mode("overwrite").parquet(
        f"{work}/demand_2025.parquet"
    )
    with pytest.raises(SourceError, match="lacks columns: weekday"):
        check_sources(spark, work, 2025)


def test_load_counts_and_rerun_is_idempotent(spark, work):
    src, raw_root = f"{work}/src", f"{work}/raw"
    year_files(spark, src, 2025, small_year(2025))
    counts = load_year(spark, src, 2025, raw_root)
    assert counts["telemetry"] == {"raw": 6, "clean": 4, "write": "created"}
    assert counts["failures"]["raw"] == 2 and counts["failures"]["clean"] == 1
    again = load_year(spark, src, 2025, raw_root)
    assert again["orders"]["write"] == "replaced"
    orders = stored(spark, raw_root, "orders")
    # the order with a NULL planned time is not duplicated by the rerun
    assert orders.count() == 2
    assert orders.where(F.col("year").isNull()).count() == 1
    tel = stored(spark, raw_root, "telemetry")
    assert tel.count() == 4 and {"load_year", "date"} <= set(tel.columns)


def test_other_years_kept_and_year_fully_replaced(spark, work):
    src, raw_root = f"{work}/src", f"{work}/raw"
    year_files(spark, src, 2024, small_year(2024))
    year_files(spark, src, 2025, small_year(2025))
    load_year(spark, src, 2024, raw_root)
    load_year(spark, src, 2025, raw_root)
    # corrected 2025 file that lost the 2 March readings
    fixed = small_year(2025)
    fixed["telemetry"] = [r for r in fixed["telemetry"] if r.get("timestamp") != ns("2025-03-02T00:00:00")]
    src2 = f"{work}/src2"
    year_files(spark, src2, 2025, fixed)
    load_year(spark, src2, 2025, raw_root)
    tel = stored(spark, raw_root, "telemetry")
    per_year = {r[0]: r[1] for r in tel.groupBy("load_year").count().collect()}
    assert per_year == {2024: 4, 2025: 3}
    assert tel.where(F.col("date") == dt.date(2025, 3, 2)).count() == 0


def test_unknown_layout_recreated(spark, work):
    src, raw_root = f"{work}/src", f"{work}/raw"
    year_files(spark, src, 2025, small_year(2025))
    spark.range(3).write.parquet(f"{raw_root}/demand")  # neither load_year nor year nor date
    assert table_layout(spark, f"{raw_root}/demand") == "unknown"
    counts = load_year(spark, src, 2025, raw_root)
    assert counts["demand"]["write"] == "recreated"
    assert stored(spark, raw_root, "demand").count() == 2


@pytest.mark.parametrize("name", ["telemetry", "failures", "maintenance", "orders", "demand"])
def test_other_layouts_are_refused_before_any_write_and_migrate_losslessly(spark, work, name):
    from millpulse.operators.clean import clean

    src, raw_root = f"{work}/src", f"{work}/raw"
    old = None
    for year in (2023, 2024):
        table = clean(raw_df(spark, name, small_year(year)[name]), name)
        old = table if old is None else old.unionByName(table)
    old.write.parquet(f"{work}/old/{name}")
    kept = old.count()
    old.write.parquet(f"{raw_root}/{name}")
    year_files(spark, src, 2025, small_year(2025))
    with pytest.raises(LayoutError):
        load_year(spark, src, 2025, raw_root)
    assert spark.read.parquet(f"{raw_root}/{name}").count() == kept
    import os

    assert os.listdir(raw_root) == [name]
    new_root = f"{work}/new"
    adopt_table(spark, new_root, name, f"{work}/old/{name}")
    with pytest.raises(ValueError, match="already"):
        adopt_table(spark, new_root, name, f"{work}/old/{name}")
    load_year(spark, src, 2025, new_root)
    load_year(spark, src, 2025, new_root)
    whole = stored(spark, new_root, name)
    assert whole.where("load_year <> 2025").count() == kept
    assert whole.where("load_year = 2025").count() == clean(raw_df(spark, name, small_year(2025)[name]), name).count()


@pytest.mark.parametrize("name", ["telemetry", "failures", "maintenance", "orders", "demand"])
def test_empty_batch_empties_exactly_its_year(spark, work, name):
    for year in (2024, 2025):
        year_files(spark, f"{work}/src", year, small_year(year))
        load_year(spark, f"{work}/src", year, f"{work}/raw")
    before = stored(spark, f"{work}/raw", name).where("load_year = 2024").count()
    year_files(spark, f"{work}/empty", 2025, {**small_year(2025), name: []})
    assert load_year(spark, f"{work}/empty", 2025, f"{work}/raw")[name] == {"raw": 0, "clean": 0, "write": "replaced"}
    got = stored(spark, f"{work}/raw", name)
    assert [r[0] for r in got.select("load_year").distinct().collect()] == [2024]
    assert got.count() == before


def test_replace_days_keeps_other_days(spark, work):
    root = f"{work}/t"
    df = spark.createDataFrame([(dt.date(2025, 1, 1), 1), (dt.date(2025, 1, 2), 2)], "date date, v int")
    replace_days(df, root)
    replace_days(spark.createDataFrame([(dt.date(2025, 1, 2), 9)], "date date, v int"), root)
    got = sorted((r["date"].day, r["v"]) for r in spark.read.parquet(root).collect())
    assert got == [(1, 1), (2, 9)]


def test_run_year_builds_models_and_report(spark, work):
    from millpulse.operators.enrich import ENRICHED_COLUMNS
    from millpulse.plans.failures import FAILURE_COLUMNS
    from millpulse.plans.production import PRODUCTION_COLUMNS

    src = f"{work}/src"
    year_files(spark, src, 2025, small_year(2025))
    counts, report = run_year(spark, src, 2025, f"{work}/raw", f"{work}/models", publish_failed=True)
    models = read_models(spark, f"{work}/models")
    enriched = models["int_telemetry_enriched"]
    assert enriched.count() == 4 and enriched.columns == ENRICHED_COLUMNS
    assert len(models["mart_machine_health"].columns) == 28
    assert models["mart_failure_analysis"].columns == FAILURE_COLUMNS
    fa = models["mart_failure_analysis"].first()
    assert fa["failure_id"] == "F1" and fa["minutes_to_first_maintenance"] == 60
    assert fa["avg_bearing_health_24h_prior"] == 0.9 and fa["was_predicted"] is True
    assert models["mart_production_performance"].columns == PRODUCTION_COLUMNS
    rep = {(r["table"], r["column"], r["check"]): r for r in report.collect()}
    assert rep[("stg_orders", "order_id", "unique")]["passed"] is True
    assert rep[("telemetry", "loaded_at", "freshness")]["passed"] is True
    # the order without a planned time has no month
    assert [k for k, r in rep.items() if not r["passed"]] == [("mart_production_performance", "month_date", "not_null")]
    assert len(rep) == 51


@pytest.mark.parametrize("empty", [["failures"], ["maintenance"], ["telemetry", "failures", "maintenance", "orders", "demand"]])
def test_tables_without_rows_end_to_end(spark, work, empty):
    src = f"{work}/src"
    rows = small_year(2025)
    # a file without rows, or one whose rows are all dropped for a missing key
    for name in empty:
        rows[name] = [] if len(empty) == 1 else [{}]
    year_files(spark, src, 2025, rows)
    counts, report = run_year(spark, src, 2025, f"{work}/raw", f"{work}/models")
    assert all(counts[name]["clean"] == 0 for name in empty)
    raw = read_raw_tables(spark, f"{work}/raw")
    assert all(raw[name].count() == 0 and raw[name].columns[:-1] == clean_schema(spark, name).names for name in empty)
    assert report.count() == 51
    if "telemetry" in empty:
        assert {r["check"] for r in report.where("not passed").collect()} == {"freshness"}


def test_main_exits_non_zero_when_a_test_fails(spark, work):
    rows = small_year(2025)
    rows["orders"] = rows["orders"][:1]  # the other one has no planned month, which is a violation
    year_files(spark, f"{work}/good", 2025, rows)
    assert pipeline.main(["--input-prefix", f"{work}/good", "--year", "2025", "--out", f"{work}/a"]) == 0
    rows["orders"].append(dict(rows["orders"][0]))
    year_files(spark, f"{work}/bad", 2025, rows)
    assert pipeline.main(["--input-prefix", f"{work}/bad", "--year", "2025", "--out", f"{work}/b"]) == 1


def test_declared_tests_need_their_table(spark):
    from millpulse.operators import quality

    with pytest.raises(KeyError, match="stg_failures"):
        quality.run_declared({"stg_telemetry": spark.range(1)})


def test_odd_order_loads_and_day_partitions_prune(spark, work):
    import contextlib
    import io

    from millpulse.operators.staging import stg_telemetry

    rows = small_year(2025)
    rows["orders"] += [{"order_id": f"x{i}", "timestamp_planned": ns("2025-05-01T00:00:00")} for i in range(3)]
    rows["orders"].append({"order_id": "far", "timestamp_planned": ns("2027-05-01T00:00:00")})
    year_files(spark, f"{work}/src", 2025, rows)
    counts = load_year(spark, f"{work}/src", 2025, f"{work}/raw")
    assert counts["orders"]["clean"] == 6
    t = stg_telemetry(read_raw_tables(spark, f"{work}/raw")["telemetry"]).where("recording_date = date'2025-03-02'")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        t.explain()
    assert "PartitionFilters: [isnotnull(date" in buf.getvalue()
    assert t.count() == 1


def test_failure_window_prunes_enriched_partitions(spark, work):
    """On the written enriched table (partitioned by recording_date) the
    day-bucketed J5 prunes partitions to failure days at run time."""
    import contextlib
    import io

    from millpulse.operators.enrich import enrich
    from millpulse.plans.failures import pre_failure_state
    from millpulse.sinks.tables import write_table
    from millpulse.sources import roles
    from tests.conftest import SF_SMALL

    r = roles.all_roles(spark, SF_SMALL)
    path = f"{work}/enriched"
    write_table(enrich(r["telemetry"], r["orders"], r["failures"], r["maintenance"], r["demand"]),
                path, ["recording_date"], ["machine_id"], rebalance_by=["recording_date"])
    p = pre_failure_state(r["failures"], spark.read.parquet(path))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        p.explain()
    assert "dynamicpruning" in buf.getvalue()
    assert p.count() > 0


def test_nanosecond_annotated_files_load_exactly(spark, work):
    """Epoch columns stored as INT64 TIMESTAMP(NANOS) instead of plain INT64:
    the source check accepts them and the declared read keeps every nanosecond."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    src, raw_root = f"{work}/src", f"{work}/raw"
    rows = small_year(2025)
    year_files(spark, src, 2025, {k: v for k, v in rows.items() if k != "failures"})
    from millpulse.sources.schemas import schema

    arrow = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [
        pa.field(f.name, pa.timestamp("ns") if f.name == "timestamp_occurrence" else arrow[f.dataType.simpleString()])
        for f in schema("failures").fields
    ]
    table = pa.Table.from_pylist(
        [{f.name: r.get(f.name) for f in fields} for r in rows["failures"]], schema=pa.schema(fields)
    )
    import os

    os.makedirs(f"{src}/failures_2025.parquet", exist_ok=True)
    pq.write_table(table, f"{src}/failures_2025.parquet/part-0.parquet")
    check_sources(spark, src, 2025)
    counts = load_year(spark, src, 2025, raw_root)
    assert counts["failures"]["clean"] == 1
    got = stored(spark, raw_root, "failures").first()["timestamp_occurrence"]
    assert got == dt.datetime(2025, 3, 1, 6, 0)


def test_column_of_wrong_type_reported(spark, work):
    rows = small_year()
    year_files(spark, work, 2025, rows)
    bad = raw_df(spark, "orders", rows["orders"]).withColumn("total_weight_tons", F.col("total_weight_tons").cast("string"))
    bad.write.mode("overwrite").parquet(f"{work}/orders_2025.parquet")
    with pytest.raises(SourceError, match="total_weight_tons is string, declared double"):
        check_sources(spark, work, 2025)


def test_failed_reload_keeps_the_previous_year(spark, work):
    """A load that fails (here a file written in microseconds trips the year check)
    leaves the loaded year readable and no files behind, and a rerun with good
    files replaces it."""
    src, raw_root = f"{work}/src", f"{work}/raw"
    year_files(spark, src, 2025, small_year(2025))
    load_year(spark, src, 2025, raw_root)
    bad = small_year(2025)
    for r in bad["telemetry"]:
        if r.get("timestamp") is not None:
            r["timestamp"] //= 1000
    src_bad = f"{work}/src_bad"
    year_files(spark, src_bad, 2025, bad)
    with pytest.raises(Exception, match="outside batch year"):
        load_year(spark, src_bad, 2025, raw_root)
    assert SnapshotStore(spark, raw_root).expire(keep=9, grace_hours=0) == []
    assert stored(spark, raw_root, "telemetry").count() == 4
    assert load_year(spark, src, 2025, raw_root)["telemetry"]["write"] == "replaced"
    assert stored(spark, raw_root, "telemetry").count() == 4


def test_empty_table_folder_counts_as_absent(spark, work):
    import os

    os.makedirs(f"{work}/raw/demand/load_year=2025")
    assert table_layout(spark, f"{work}/raw/demand") == "absent"
