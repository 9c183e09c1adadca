"""T6 and the model build: the yearly job end to end.

``load_year``    presence, columns and stored layouts first (footers only).  Then the five
                 files are cleaned and staged side by side, each read once: row counts
                 (K9), years, the declared source tests and the load stamp are observed
                 in the write.  One manifest publishes all five tables of the year (K1-K4);
                 a load that fails, or whose files are of another year, publishes nothing.
``build_models`` write, audit, publish: the enriched table and the three marts are staged,
                 the declared data tests run on the staged set, and one manifest
                 publishes all of them, only if the tests pass (K6).  M3 does not wait
                 for the enriched table.  Where the stored models were built from an
                 earlier snapshot of the raw tables, only the partitions that the
                 changes since then reach are rebuilt (``refresh``).
``run_year``     both, in the order replace year -> rebuild marts.

Raw and model tables are read with their declared columns, so tables without
rows work like any other.

Run with spark-submit (ship the package with ``--py-files``); the exit status is
1 when a data test fails::

    zip -r millpulse.zip millpulse
    spark-submit --py-files millpulse.zip millpulse/plans/pipeline.py \
        --input-prefix PREFIX --year 2025 --out ROOT
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from millpulse.operators import quality
from millpulse.operators.clean import clean, year_metrics
from millpulse.operators.clustering import curve_bounds
from millpulse.operators.staging import stage_all
from millpulse.plans import refresh
from millpulse.plans.steps import StepsFailed, run_steps
from millpulse.session import apply_sql_defaults
from millpulse.sinks.drift import fitted
from millpulse.sinks.snapshots import Batch, Change, Snapshot, SnapshotStore
from millpulse.sinks.tables import LOAD_YEAR, check_layouts
from millpulse.sources.files import SourceError, check_sources, read_raw
from millpulse.sources.schemas import SOURCE_NAMES, schema

# Raw tables: cluster columns and day partition inside each load_year.
RAW_LAYOUT = {"telemetry": (["machine_id"], "date")}
# Model tables: partition column, cluster columns and, for more than one, the staged table that has them.
MODEL_LAYOUT = {
    "int_telemetry_enriched": (["recording_date"], ["machine_id"], None),
    "mart_machine_health": (["recording_date"], ["machine_id"], None),
    "mart_failure_analysis": (["occurrence_date"], ["machine_id", "failure_category"], "failures"),
    "mart_production_performance": (["month_date"], ["machine_id", "market"], "orders"),
}
REPORT = "data_tests"


# -- raw tables ----------------------------------------------------------------------


def clean_schema(spark: SparkSession, name: str) -> StructType:
    """The declared columns of a cleaned table."""
    fields = clean(spark.createDataFrame([], schema(name)), name).schema.fields
    return StructType([StructField(f.name, f.dataType, True) for f in fields])


def raw_schema(spark: SparkSession, name: str) -> StructType:
    """The columns of a stored raw table: the cleaned ones and its batch year."""
    return StructType([*clean_schema(spark, name).fields, StructField(LOAD_YEAR, IntegerType())])


def _stage_raw(store: SnapshotStore, base: Snapshot, name: str, df: DataFrame, metrics: dict) -> Batch:
    if name in base.schemas:
        df = fitted(df, base.schema(name))
    cluster, day = RAW_LAYOUT.get(name, ([], None))
    metrics = {**metrics, **quality.check_metrics(quality.DECLARED_SOURCE_TESTS[name])}
    if name in quality.FRESHNESS:
        field, _ = quality.FRESHNESS[name]
        metrics[f"latest.{field}"] = F.max(F.unix_micros(field))
    return store.stage(name, df, [LOAD_YEAR, *([day] if day else [])], cluster, [day] if day else [], metrics)


def check_years(batches: dict[str, Batch], year: int, most_outside: float = 0.5) -> None:
    """Raise if a staged file's timestamps are not of the batch year, by what its write has observed.

    A column fails when more than ``most_outside`` of its values lie outside the accepted
    years: that is a file of another year or unit (micro- instead of nanoseconds read
    as 1970), not an odd order planned far ahead.  ``most_outside=1`` turns the check off.
    """
    bad = []
    for name, batch in batches.items():
        for key, values in batch.metrics.items():
            if key.startswith("values."):
                column = key.removeprefix("values.")
                outside = batch.metrics[f"outside.{column}"]
                if outside > most_outside * values:
                    bad.append(f"{name}.{column}: {outside} of {values} (is the file in nanoseconds?)")
    if bad:
        raise SourceError(f"values outside batch year {year}: " + "; ".join(bad))


def load_year(spark: SparkSession, prefix: str, year: int, raw_root: str, slack_years: int = 1, most_outside: float = 0.5) -> dict[str, dict]:
    """Load the five yearly files into the store at ``raw_root``; returns row counts."""
    apply_sql_defaults(spark)
    year, raw_root = int(year), raw_root.rstrip("/")
    check_sources(spark, prefix, year)
    outside = check_layouts(spark, [f"{raw_root}/{name}" for name in SOURCE_NAMES])
    store = SnapshotStore(spark, raw_root)
    base = store.current()

    def stage(name: str):
        table = clean(read_raw(spark, prefix, name, year), name).withColumn(LOAD_YEAR, F.lit(year))
        return lambda done: _stage_raw(store, base, name, table, year_metrics(name, year - slack_years, year + slack_years))

    try:
        batches = run_steps(spark, {name: ((), stage(name)) for name in SOURCE_NAMES}, at_once=len(SOURCE_NAMES))
    except StepsFailed as failed:
        store.discard(failed.done.values())
        raise next(iter(failed.errors.values())) from failed
    scope = f"{LOAD_YEAR}={year}"
    try:
        check_years(batches, year, most_outside)
        store.commit(base, [Change(b, scope) for b in batches.values()], {"loaded": year})
    except Exception:
        store.discard(batches.values())
        raise
    counts: dict[str, dict] = {}
    for name, b in batches.items():
        had = any(p == scope or p.startswith(f"{scope}/") for p in base.parts(name))
        action = "replaced" if had else "recreated" if outside[f"{raw_root}/{name}"] == "unknown" else "created"
        # the raw count is answered from parquet row-group metadata
        counts[name] = {"raw": read_raw(spark, prefix, name, year).count(), "clean": b.rows, "write": action}
    return counts


def adopt_table(spark: SparkSession, raw_root: str, name: str, old_root: str, year_from: str | None = None) -> Snapshot:
    """Take a raw table from another layout into the store, all its years kept.

    The batch year is ``year_from`` (the year of it, for a date); by default ``load_year``,
    ``year`` or ``date``, whichever the table has first.  Rows whose year is unknown go to
    load_year 0, which no load replaces.  A table that the store has already is refused.
    """
    store = SnapshotStore(spark, raw_root)
    base = store.current()
    if base.parts(name):
        raise ValueError(f"{name} is in the store already")
    df = spark.read.parquet(old_root)
    column = year_from or next((c for c in (LOAD_YEAR, "year", "date") if c in df.columns), None)
    if column is None:
        raise ValueError(f"{old_root} has no load_year, year or date")
    year = F.year(column) if df.schema[column].dataType.simpleString() in ("date", "timestamp") else F.col(column)
    wanted = [F.col(f.name).cast(f.dataType).alias(f.name) for f in clean_schema(spark, name).fields]
    rows = df.withColumn("__year", F.coalesce(year, F.lit(0)).cast("int")).select(*wanted, F.col("__year").alias(LOAD_YEAR))
    return store.commit(base, [Change(_stage_raw(store, base, name, rows, {}))])


def read_raw_tables(spark: SparkSession, raw_root: str, snapshot: Snapshot | None = None) -> dict[str, DataFrame]:
    """The cleaned tables as of one snapshot."""
    store = SnapshotStore(spark, raw_root)
    snapshot = snapshot or store.current()
    return {name: store.read(name, snapshot, raw_schema(spark, name)) for name in SOURCE_NAMES}


# -- models --------------------------------------------------------------------------


def read_models(spark: SparkSession, model_root: str) -> dict[str, DataFrame]:
    """The published models, all of one build."""
    store = SnapshotStore(spark, model_root)
    snapshot = store.current()
    return {name: store.read(name, snapshot) for name in MODEL_LAYOUT}


def _observed(spark: SparkSession, name: str, checks: list, snapshot: Snapshot, table: DataFrame) -> list[DataFrame]:
    """Row-level checks of a stored table: as observed at its writes, counted again only where that is not known."""
    known = []
    for b in snapshot.tables.get(name, {}).values():
        counts = {k: v for k, v in b.metrics.items() if k.startswith("check.")}
        # a batch that is live in part has no more violations than it had as a whole
        known.append(counts if len(b.parts) == b.written or not any(counts.values()) else {})
    report = quality.observed_checks(spark, name, checks, known)
    rows = report if report is not None else quality.row_checks(table, name, [c for c in checks if c[1] != "unique"])
    return [rows, *(quality.unique_check(table, name, column) for column, check, _ in checks if check == "unique")]


def audit(spark: SparkSession, raw_store: SnapshotStore, raw: Snapshot, model_store: SnapshotStore, models: Snapshot, as_of: dt.datetime | None = None) -> DataFrame:
    """The declared tests on a set of raw and model tables, staged or published."""
    tables = {name: raw_store.read(name, raw, raw_schema(spark, name)) for name in SOURCE_NAMES}
    staged = stage_all(tables)
    parts: list[DataFrame] = []
    for name, checks in quality.DECLARED_MODEL_TESTS.items():
        if name.startswith("stg_"):
            parts.append(quality.run_checks(staged[name[4:]], name, checks))
        else:
            parts += _observed(spark, name, checks, models, model_store.read(name, models))
    for name, checks in quality.DECLARED_SOURCE_TESTS.items():
        parts += _observed(spark, name, checks, raw, tables[name])
    as_of = as_of or dt.datetime.now(dt.timezone.utc)
    for name, (field, days) in quality.FRESHNESS.items():
        stamps = [b.metrics.get(f"latest.{field}") for b in raw.tables.get(name, {}).values()]
        if stamps and None not in stamps:
            latest = spark.createDataFrame([(max(stamps),)], "us bigint").select(F.timestamp_micros("us").alias(field))
        else:
            latest = tables[name]
        parts.append(quality.freshness_check(latest, name, field, as_of, days))
    return reduce(DataFrame.unionByName, parts)


def build_models(spark: SparkSession, raw_root: str, model_root: str, as_of: dt.datetime | None = None, full: bool = False, publish_failed: bool = False) -> DataFrame:
    """Bring the models up to the raw tables' current snapshot; returns the data-test report.

    Nothing is published where a test fails, but for the report, unless ``publish_failed``.
    ``full`` rebuilds every partition.
    """
    apply_sql_defaults(spark)
    raw_store, store = SnapshotStore(spark, raw_root), SnapshotStore(spark, model_root)
    raw, base = raw_store.current(), store.current()
    staged = stage_all({name: raw_store.read(name, raw, raw_schema(spark, name)) for name in SOURCE_NAMES})
    touched = None if full else refresh.touched_since(spark, raw_store, raw, base, staged)
    build = refresh.Build(store, base, staged, touched)

    def save(name: str):
        def run(done: dict) -> Change | None:
            made = build.table(name, done)
            if made is None:
                return None
            df, gone = made
            partition_by, cluster_by, source = MODEL_LAYOUT[name]
            curve = curve_bounds(staged[source], cluster_by) if source else None
            metrics = quality.check_metrics(quality.DECLARED_MODEL_TESTS[name])
            batch = store.stage(name, df, partition_by, cluster_by, metrics=metrics, curve=curve)
            return Change(batch) if gone is None else Change(batch, None, frozenset(refresh.part(partition_by[0], v) for v in gone))

        return run

    steps = {name: (refresh.NEEDS[name], save(name)) for name in MODEL_LAYOUT}
    try:
        changes = [c for c in run_steps(spark, steps).values() if c is not None]
    except StepsFailed as failed:
        store.discard(c.batch for c in failed.done.values() if c is not None)
        raise next(iter(failed.errors.values())) from failed
    rows = audit(spark, raw_store, raw, store, base.after(changes), as_of).collect()  # a row a check
    report = spark.createDataFrame(rows, "table string, column string, check string, params string, violations bigint, passed boolean")
    told = Change(store.stage(REPORT, report.coalesce(1)))
    if publish_failed or all(r["passed"] for r in rows):
        store.commit(base, [*changes, told], {"raw_version": raw.version, "audit": "passed" if all(r["passed"] for r in rows) else "failed"})
    else:
        store.discard(c.batch for c in changes)
        store.commit(base, [told], {"audit": "failed", "rejected_raw_version": raw.version})
    return store.read(REPORT)


def run_year(spark: SparkSession, prefix: str, year: int, raw_root: str, model_root: str, publish_failed: bool = False) -> tuple[dict, DataFrame]:
    counts = load_year(spark, prefix, year, raw_root)
    return counts, build_models(spark, raw_root, model_root, publish_failed=publish_failed)


def main(argv: list[str] | None = None) -> int:
    """Run one year; 0 when all data tests passed, else 1."""
    from millpulse.session import get_session

    p = argparse.ArgumentParser(description="Load one year of plant files and rebuild the marts")
    p.add_argument("--input-prefix", required=True)
    p.add_argument("--year", required=True, type=int)
    p.add_argument("--out", required=True, help="table root on shared storage")
    p.add_argument("--publish-failed", action="store_true", help="publish the models even where a data test fails")
    a = p.parse_args(argv)
    spark = get_session(app_name=f"millpulse-{a.year}", extra={"spark.scheduler.mode": "FAIR"})
    counts, report = run_year(spark, a.input_prefix, a.year, f"{a.out}/raw", f"{a.out}/models", a.publish_failed)
    for name, c in counts.items():
        print(f"{name}: raw {c['raw']:,} clean {c['clean']:,} ({c['write']})")
    failed = report.where(~F.col("passed"))
    failed.show(truncate=False)
    return 0 if failed.isEmpty() else 1


if __name__ == "__main__":
    sys.exit(main())
