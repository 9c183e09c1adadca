"""Registered queries of the write side: load, replace, publish and refresh, read back.

Each query writes the driver's whole tables, in their raw shapes (``raw_roles``), as two yearly
files a source (rows up to 1995 and without a date; rows from 1996 on), runs the yearly job
on them under a scratch root and returns what a reader then sees.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.functions import ns_to_timestamp
from millpulse.operators import quality
from millpulse.operators.clean import clean
from millpulse.plans.pipeline import build_models, load_year, read_models, read_raw_tables
from millpulse.plans.steps import StepsFailed, run_steps
from millpulse.session import apply_sql_defaults
from millpulse.sinks.catalog import register
from millpulse.sinks.drift import fitted
from millpulse.sinks.scratch import scratch_root
from millpulse.sinks.snapshots import Change, SnapshotStore
from millpulse.sinks.tables import LOAD_YEAR
from millpulse.sources import raw_roles
from millpulse.sources.files import year_path
from millpulse.sources.footers import not_null_checks, row_counts
from millpulse.sources.schemas import SOURCE_NAMES, schema

#: The column whose year tells a raw row's file.
YEAR_OF = {"telemetry": "timestamp", "failures": "timestamp_occurrence", "maintenance": "timestamp_start", "orders": "timestamp_planned", "demand": "date"}
YEARS = (1995, 1996)


def _in_year(name: str, year: int) -> Column:
    column = YEAR_OF[name]
    late = F.coalesce(F.year(column if name == "demand" else ns_to_timestamp(column)) > YEARS[0], F.lit(False))
    return late if year == YEARS[1] else ~late


def _write_years(spark: SparkSession, tables: dict[str, DataFrame], prefix: str, years=YEARS) -> str:
    """The yearly files of all sources, written side by side."""

    def write(name: str, year: int):
        return lambda done: tables[name].where(_in_year(name, year)).write.parquet(year_path(prefix, name, year))

    try:
        run_steps(spark, {f"{name}_{year}": ((), write(name, year)) for year in years for name in tables}, at_once=len(tables))
    except StepsFailed as failed:
        raise next(iter(failed.errors.values())) from failed
    return prefix


def _written(spark: SparkSession, prefix: str, years=YEARS) -> dict[str, DataFrame]:
    """The sources as their yearly files hold them."""
    return {n: spark.read.schema(schema(n)).parquet(*(year_path(prefix, n, y) for y in years)) for n in SOURCE_NAMES}


def _load(spark: SparkSession, prefix: str, raw_root: str, years=YEARS) -> dict[int, dict]:
    # the tables' dates span more than a batch year: the year check is off
    return {year: load_year(spark, prefix, year, raw_root, most_outside=1.0) for year in years}


def _loaded(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, dict[str, DataFrame], dict[int, dict]]:
    """(root, raw tables, counts) with both years loaded below ``{root}/raw``; the tables are read from the files written."""
    apply_sql_defaults(spark)
    root = scratch_root(spark, name)
    made = {n: make(spark, sf_dir) for n, make in raw_roles.RAW_ROLES.items()}
    src = _write_years(spark, made, f"{root}/src")
    return root, _written(spark, src), _load(spark, src, f"{root}/raw")


def corrected_orders(orders: DataFrame) -> DataFrame:
    """A correction: urgent orders are cancelled, weights are twice what they were."""
    kept = F.coalesce(F.col("market") != "1-URGENT", F.lit(True))
    return orders.where(kept).withColumn("total_weight_tons", F.col("total_weight_tons") * 2)


def corrected_telemetry(telemetry: DataFrame) -> DataFrame:
    """A correction: readings of purchases are void, bearings of one day were rated too well."""
    day = F.to_date(ns_to_timestamp("timestamp"))
    health = F.when(day == F.lit("1999-01-10").cast("date"), F.col("bearing_health") / 2).otherwise(F.col("bearing_health"))
    return telemetry.where("status <> 'purchase'").withColumn("bearing_health", health)


def t6_load_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 counts of both loads, beside what the stored tables hold."""
    root, _, counts = _loaded(spark, sf_dir, "t6")
    told = [(n, y, c["raw"], c["clean"], c["write"]) for y, by in counts.items() for n, c in by.items()]
    report = spark.createDataFrame(told, "source string, load_year int, raw_rows bigint, clean_rows bigint, written string")
    days = {"telemetry": "date", "failures": "date", "maintenance": "date", "orders": "date_planned", "demand": "date"}
    held = None
    for name, df in read_raw_tables(spark, f"{root}/raw").items():
        one = df.groupBy("load_year").agg(F.count("*").alias("stored_rows"), F.min(days[name]).alias("first_day"), F.max(days[name]).alias("last_day")).withColumn("source", F.lit(name))
        held = one if held is None else held.unionByName(one)
    return report.join(held, ["source", "load_year"], "left").withColumn("stored_rows", F.coalesce("stored_rows", F.lit(0).cast("bigint")))


def k1_day_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry of all days, then corrected readings of the second week only; days are replaced, all others stay."""
    apply_sql_defaults(spark)
    store = SnapshotStore(spark, scratch_root(spark, "k1"))
    raw = raw_roles.telemetry(spark, sf_dir)

    def put(df: DataFrame) -> None:
        batch = store.stage("telemetry", clean(df, "telemetry"), ["date"], ["machine_id"])
        store.commit(store.current(), [Change(batch, None)])

    put(raw)
    week = F.to_date(ns_to_timestamp("timestamp")).between("1999-01-08", "1999-01-14")
    put(corrected_telemetry(raw).where(week))
    return store.read("telemetry").select("date", "machine_id", "status", "bearing_health", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


def k3_year_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after a corrected file of the first year was loaded; the other year is untouched."""
    root, tables, _ = _loaded(spark, sf_dir, "k3")
    mended = _write_years(spark, {**tables, "orders": corrected_orders(tables["orders"])}, f"{root}/mended", YEARS[:1])
    _load(spark, mended, f"{root}/raw", YEARS[:1])
    orders = read_raw_tables(spark, f"{root}/raw")["orders"]
    return orders.select("load_year", "order_id", "market", "date_planned", "total_weight_tons", "is_completed")


def k5_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged orders by name, seen through a later load without registering again."""
    root, tables, _ = _loaded(spark, sf_dir, "k5")
    views = register(spark, f"{root}/raw", prefix="k5_")
    try:
        mended = _write_years(spark, {**tables, "orders": corrected_orders(tables["orders"])}, f"{root}/mended", YEARS[:1])
        _load(spark, mended, f"{root}/raw", YEARS[:1])
        return spark.sql("SELECT order_id, market, planned_date, total_weight_tons, is_delayed FROM k5_stg_orders WHERE market IS NOT NULL")
    finally:
        views.close()


def k6_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production mart as published; a later build whose tests fail is refused."""
    root, tables, _ = _loaded(spark, sf_dir, "k6")
    build_models(spark, f"{root}/raw", f"{root}/models", publish_failed=True)
    mended = _write_years(spark, {**tables, "orders": corrected_orders(tables["orders"])}, f"{root}/mended", YEARS[:1])
    _load(spark, mended, f"{root}/raw", YEARS[:1])
    build_models(spark, f"{root}/raw", f"{root}/models")
    return read_models(spark, f"{root}/models")["mart_production_performance"]


def k7_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine health after corrected telemetry, from the partitions that the correction reaches."""
    root, tables, _ = _loaded(spark, sf_dir, "k7")
    build_models(spark, f"{root}/raw", f"{root}/models", publish_failed=True)
    mended = _write_years(spark, {**tables, "telemetry": corrected_telemetry(tables["telemetry"])}, f"{root}/mended", YEARS[1:])
    _load(spark, mended, f"{root}/raw", YEARS[1:])
    build_models(spark, f"{root}/raw", f"{root}/models", publish_failed=True)
    return read_models(spark, f"{root}/models")["mart_machine_health"]


def d1_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources' not-null tests on the stored tables, from row-group counts."""
    root, _, _ = _loaded(spark, sf_dir, "d1")
    store = SnapshotStore(spark, f"{root}/raw")
    parts = [not_null_checks(store, name, checks) for name, checks in quality.DECLARED_SOURCE_TESTS.items()]
    return reduce(DataFrame.unionByName, parts)


def d6_stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the stored tables from the manifest, and of telemetry, replaced in part, from footers."""
    root, tables, _ = _loaded(spark, sf_dir, "d6")
    store = SnapshotStore(spark, f"{root}/raw")
    week = F.to_date(ns_to_timestamp("timestamp")).between("1999-01-08", "1999-01-14")
    rows = clean(corrected_telemetry(tables["telemetry"]).where(week), "telemetry").withColumn(LOAD_YEAR, F.lit(YEARS[1]))
    base = store.current()
    store.commit(base, [Change(store.stage("telemetry", fitted(rows, base.schema("telemetry")), [LOAD_YEAR, "date"]), None)])
    return row_counts(store, SOURCE_NAMES)


QUERIES = {
    "d1_footers": d1_footers,
    "d6_stored_rows": d6_stored_rows,
    "t6_load_year": t6_load_year,
    "k1_day_replace": k1_day_replace,
    "k3_year_replace": k3_year_replace,
    "k5_view": k5_view,
    "k6_publish": k6_publish,
    "k7_refresh": k7_refresh,
}
