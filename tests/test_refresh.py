"""Incremental refresh against full rebuilds; write, audit, publish."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millpulse.operators import quality
from millpulse.plans import pipeline, refresh, stored
from millpulse.plans.pipeline import MODEL_LAYOUT, audit, build_models, load_year, read_models, raw_schema
from millpulse.operators.staging import stage_all
from millpulse.sinks.snapshots import SnapshotStore
from millpulse.sources import raw_roles
from millpulse.sources.schemas import SOURCE_NAMES
from tests.conftest import SF_SMALL, plan_of
from tests.fixtures import ns, reading, small_year, year_files

MACHINES = ["M1", "M2", "M3"]


def clean_year(year):
    """A year whose declared tests all pass."""
    rows = small_year(year)
    rows["orders"] = rows["orders"][:1]
    for name, key in (("failures", "failure_id"), ("maintenance", "maintenance_id"), ("orders", "order_id")):
        for r in rows[name]:
            if r[key] is not None:
                r[key] = f"{r[key]}-{year}"
    return rows


def random_year(rng, year, days=24):
    day = lambda d, h=0: f"{dt.date(year, 1, 1) + dt.timedelta(days=d)}T{h:02d}:00:00"
    ids = {k: [f"{k}{year}-{i}" for i in range(8)] for k in ("O", "F", "T")}
    telemetry = [
        reading(m, day(d, h), bearing_health=rng.random(), motor_health=rng.random(), active_order_id=rng.choice([None, *ids["O"]]), last_failure_id=rng.choice([None, *ids["F"]]),
                active_maintenance_id=rng.choice([None, None, *ids["T"]]), label_failure_in_24h=rng.randrange(2))
        for d in range(days) for m in MACHINES if rng.random() < 0.8 for h in (3, 15)
    ]
    failures = [{"failure_id": f, "machine_id": rng.choice(MACHINES), "timestamp_occurrence": ns(day(rng.randrange(days), 9)), "failure_category": rng.choice("ab"), "severity_level": 2} for f in ids["F"]]
    failures.append(dict(failures[0], timestamp_occurrence=ns(day(days - 1, 20))))  # an id on two days
    maintenance = [{"maintenance_id": t, "machine_id": rng.choice(MACHINES), "timestamp_start": ns(day(rng.randrange(days), 11)), "is_planned": True, "linked_failure_id": rng.choice([None, *ids["F"]]), "duration_minutes": 30} for t in ids["T"]]
    orders = [
        {"order_id": o, "timestamp_planned": rng.choice([None, ns(day(rng.randrange(0, 90)))]), "timestamp_start": ns(day(1)), "timestamp_end": ns(day(1, 5)), "market": rng.choice("xy"), "steel_grade": "S",
         "total_weight_tons": rng.randrange(1, 50) / 2, "machine_id_started": rng.choice(MACHINES), "duration_minutes_planned": 100.0, "is_completed": rng.random() < 0.8}
        for o in ids["O"]
    ]
    demand = [{"date": dt.date(year, 1, 1) + dt.timedelta(days=d), "trend_index": 1.0, "seasonal_index": 1.0, "expected_total_tons": float(rng.randrange(10, 99))} for d in range(60)]
    return {"telemetry": telemetry, "failures": failures, "maintenance": maintenance, "orders": orders, "demand": demand}


def corrected(rng, rows, how):
    """The year's rows with a few faults mended."""
    out = {k: [dict(r) for r in v] for k, v in rows.items()}
    if "telemetry" in how:
        lost = rng.choice(out["telemetry"])["timestamp"] // 86_400_000_000_000
        out["telemetry"] = [r for r in out["telemetry"] if r["timestamp"] // 86_400_000_000_000 != lost]
        rng.choice(out["telemetry"])["bearing_health"] = 0.123
        out["telemetry"].append(reading("M2", rng.choice(["2025-01-05T06:00:00", "2025-01-20T23:00:00"]), motor_health=0.5))
    if "orders" in how:
        rng.choice(out["orders"])["market"] = "new"
        out["orders"].pop(rng.randrange(len(out["orders"])))
    if "failures" in how:
        rng.choice(out["failures"])["failure_category"] = "new"
        out["failures"].pop(rng.randrange(len(out["failures"])))
    if "maintenance" in how:
        rng.choice(out["maintenance"])["duration_minutes"] = 77
    if "demand" in how:
        rng.choice(out["demand"])["expected_total_tons"] = 1000.0
    return out


def content(spark, root):
    return {name: sorted(map(str, df.collect())) for name, df in read_models(spark, root).items()}


@pytest.mark.parametrize(("seed", "how"), [(1, ("telemetry",)), (2, ("orders", "demand")), (3, ("failures", "maintenance")), (4, ("telemetry", "orders", "failures", "maintenance", "demand"))])
def test_refresh_equals_full_rebuild(spark, tmp_path, seed, how):
    rng = random.Random(seed)
    raw, models = f"{tmp_path}/raw", f"{tmp_path}/models"
    years = {y: random_year(rng, y) for y in (2024, 2025)}
    for y, rows in years.items():
        year_files(spark, f"{tmp_path}/src", y, rows)
        load_year(spark, f"{tmp_path}/src", y, raw)
    build_models(spark, raw, models, publish_failed=True)
    store = SnapshotStore(spark, models)
    before = store.current()
    year_files(spark, f"{tmp_path}/mended", 2025, corrected(rng, years[2025], how))
    load_year(spark, f"{tmp_path}/mended", 2025, raw)
    build_models(spark, raw, models, publish_failed=True)
    build_models(spark, raw, f"{tmp_path}/whole", publish_failed=True)
    now, whole = content(spark, models), content(spark, f"{tmp_path}/whole")
    for name in MODEL_LAYOUT:
        assert now[name] == whole[name], name
    # partitions out of reach keep their files: all of the other year but for January 2025's neighbours
    after = store.current()
    for name, (partition_by, _, _) in MODEL_LAYOUT.items():
        a, b = before.parts(name), after.parts(name)
        kept = [p for p in a if b.get(p) == a[p]]
        assert kept and all(p in kept for p in a if "=2024-" in p), name
    if "telemetry" not in how and "demand" not in how:
        assert len([p for p in before.parts("int_telemetry_enriched") if after.parts("int_telemetry_enriched")[p] == before.parts("int_telemetry_enriched")[p]]) > 24


def test_same_year_again_rewrites_nothing(spark, tmp_path):
    raw, models = f"{tmp_path}/raw", f"{tmp_path}/models"
    year_files(spark, f"{tmp_path}/src", 2025, clean_year(2025))
    for _ in range(2):
        load_year(spark, f"{tmp_path}/src", 2025, raw)
        build_models(spark, raw, models)
    first, last = (SnapshotStore(spark, models).at(v) for v in (1, 2))
    assert last.meta["raw_version"] == 2
    for name in MODEL_LAYOUT:
        assert first.parts(name) == last.parts(name)


def test_next_rows_counts_rows_not_days(spark):
    D = dt.date
    days = [D(2025, 1, d) for d in (1, 2, 3, 5, 8, 13, 14, 15, 20, 21)]
    stored = spark.createDataFrame([("A", d) for d in days] + [("B", d) for d in days[5:]], "machine_id string, recording_date date")
    # A's row of the 2nd is gone: the six rows after it are reached; B has no row there
    now = stored.where("machine_id = 'A' and recording_date = date'2025-01-01'").limit(0)
    assert refresh.next_rows(stored, now, {D(2025, 1, 2)}) == {*days[1:8]}
    # a new first row of B reaches its six next ones
    now = spark.createDataFrame([("B", D(2025, 1, 4))], "machine_id string, recording_date date")
    assert refresh.next_rows(stored, now, {D(2025, 1, 4)}) == {D(2025, 1, 4), *days[5:]}


def test_failing_tests_leave_the_old_set_current(spark, tmp_path):
    raw, models = f"{tmp_path}/raw", f"{tmp_path}/models"
    year_files(spark, f"{tmp_path}/src", 2025, clean_year(2025))
    load_year(spark, f"{tmp_path}/src", 2025, raw)
    assert build_models(spark, raw, models).where("not passed").isEmpty()
    good = content(spark, models)
    bad = clean_year(2025)
    bad["orders"].append(dict(bad["orders"][0], total_weight_tons=99.0))  # the id twice
    bad["telemetry"][0]["bearing_health"] = 0.1
    year_files(spark, f"{tmp_path}/bad", 2025, bad)
    load_year(spark, f"{tmp_path}/bad", 2025, raw)
    report = build_models(spark, raw, models)
    assert {(r["table"], r["check"]) for r in report.where("not passed").collect()} == {("stg_orders", "unique"), ("orders", "unique")}
    store = SnapshotStore(spark, models)
    assert content(spark, models) == good and store.current().meta["audit"] == "failed"
    assert store.current().meta["raw_version"] == 1 and store.current().meta["rejected_raw_version"] == 2
    # nothing of the refused set is left, and the mended year is published
    assert all(not gone.startswith("mart_") for gone in store.expire(keep=9, grace_hours=0))
    load_year(spark, f"{tmp_path}/src", 2025, raw)
    assert build_models(spark, raw, models).where("not passed").isEmpty()
    assert content(spark, models) == good and store.current().meta["raw_version"] == 3
    build_models(spark, raw, models, publish_failed=True, full=True)
    assert content(spark, models) == good


def test_a_failing_model_publishes_nothing(spark, tmp_path, monkeypatch):
    raw, models = f"{tmp_path}/raw", f"{tmp_path}/models"
    year_files(spark, f"{tmp_path}/src", 2025, clean_year(2025))
    load_year(spark, f"{tmp_path}/src", 2025, raw)
    build_models(spark, raw, models)
    version, good = SnapshotStore(spark, models).current().version, content(spark, models)
    broken = refresh.failure_analysis
    monkeypatch.setattr(refresh, "failure_analysis", lambda *a: broken(*a).withColumn("failure_id", F.raise_error(F.lit("broken")).cast("string")))
    with pytest.raises(Exception, match="broken"):
        build_models(spark, raw, models, full=True)
    assert SnapshotStore(spark, models).current().version == version and content(spark, models) == good


def test_observed_report_equals_a_scan(spark, tmp_path):
    raw, models = f"{tmp_path}/raw", f"{tmp_path}/models"
    rows = small_year(2025)  # with violations
    year_files(spark, f"{tmp_path}/src", 2025, rows)
    load_year(spark, f"{tmp_path}/src", 2025, raw)
    as_of = dt.datetime(2030, 1, 1)
    build_models(spark, raw, models, as_of=as_of, publish_failed=True)
    raw_store, store = SnapshotStore(spark, raw), SnapshotStore(spark, models)
    tables = {n: raw_store.read(n, schema=raw_schema(spark, n)) for n in SOURCE_NAMES}
    every = {f"stg_{n}": df for n, df in stage_all(tables).items()} | read_models(spark, models)
    want = quality.run_declared(every).unionByName(quality.run_declared(tables, quality.DECLARED_SOURCE_TESTS))
    want = want.unionByName(quality.freshness_check(tables["telemetry"], "telemetry", "loaded_at", as_of, 400))
    got = audit(spark, raw_store, raw_store.current(), store, store.current(), as_of)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) == sorted(map(str, store.read("data_tests").collect()))
    assert not got.where("not passed").isEmpty()
    # row-level checks of the stored models come from the manifest: only the unique check reads one
    scans = got._jdf.queryExecution().executedPlan().toString()
    assert "mart_machine_health" not in scans and "int_telemetry_enriched" not in scans


def test_loads_read_each_file_once(spark, tmp_path, monkeypatch):
    year_files(spark, f"{tmp_path}/src", 2025, clean_year(2025))
    jobs = []
    stage = SnapshotStore.stage
    monkeypatch.setattr(SnapshotStore, "stage", lambda self, table, *a, **k: (jobs.append(table), stage(self, table, *a, **k))[1])
    load_year(spark, f"{tmp_path}/src", 2025, f"{tmp_path}/raw")
    assert sorted(jobs) == sorted(SOURCE_NAMES)
    batch = next(iter(SnapshotStore(spark, f"{tmp_path}/raw").current().tables["telemetry"].values()))
    assert batch.metrics["values.timestamp"] == 4 and batch.metrics["outside.timestamp"] == 0 and batch.metrics["check.machine_id.not_null"] == 0
    assert pipeline.check_years({"telemetry": batch}, 2025) is None


def test_prints_tell_rows_by_their_counts(spark):
    columns = "day date, a string, b double"
    d = dt.date(2025, 1, 1)
    days = [d + dt.timedelta(days=i) for i in range(4)]
    one = [(days[0], "x", 1.0), (days[0], "x", 1.0), (days[0], "y", 2.0), (days[1], None, None), (days[2], "x", 1.0), (None, "x", 1.0)]
    two = [(days[0], "x", 1.0), (days[0], "y", 2.0), (days[0], "y", 2.0), (days[1], None, None), (days[3], "x", 1.0), (None, "x", 2.0)]
    pair = [spark.createDataFrame(r, columns) for r in (one, two)]
    assert refresh._prints(pair, "day") == {days[0], days[2], days[3], None}
    assert refresh._prints([pair[0], pair[0].repartition(3)], "day") == set()


def test_prints_sum_longs(spark, monkeypatch):
    """Decimal sums of hashes took most of the time of finding what a reload touches."""
    plans = []
    monkeypatch.setattr(refresh, "_dates", lambda df: plans.append(plan_of(df)) or set())
    refresh._prints([spark.range(9).selectExpr("id % 2 AS k", "id")] * 2, "k")
    assert "xxhash64" in plans[0] and "decimal" not in plans[0]


def test_corrected_files_are_made_from_written_ones(spark):
    """The source tables are read and summed up once, not again for every correction."""
    root, tables, counts = stored._loaded(spark, SF_SMALL, "again")
    for name, df in tables.items():
        made = raw_roles.RAW_ROLES[name](spark, SF_SMALL)
        assert df.dtypes == made.dtypes and all(f"{root}/src/" in f for f in df.inputFiles()), name
        assert df.exceptAll(made).isEmpty() and made.exceptAll(df).isEmpty(), name
        assert df.count() == sum(by[name]["raw"] for by in counts.values()), name
