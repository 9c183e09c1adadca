"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's whole tables through the role views and runs the
library's operators on them; ``millpulse.oracle.ORACLE`` holds the DuckDB SQL
of the same name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.functions import elapsed_minutes, minutes_between, ns_to_timestamp, timestamp_to_ns
from millpulse.operators import quality
from millpulse.operators.clean import CLEANERS, clean
from millpulse.operators.enrich import enrich
from millpulse.operators.interval_join import window_join
from millpulse.operators.staging import STAGERS
from millpulse.plans import dashboard, stored
from millpulse.plans.failures import failure_analysis, post_failure_maintenance, pre_failure_state
from millpulse.plans.health import daily_machine_health, machine_health, with_status
from millpulse.plans.production import monthly_demand, monthly_orders, production_performance
from millpulse.session import apply_sql_defaults
from millpulse.sources import raw_roles, roles

Query = Callable[[SparkSession, str], DataFrame]


def _roles(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    apply_sql_defaults(spark)
    return roles.all_roles(spark, sf_dir)


def _enriched(r: dict[str, DataFrame]) -> DataFrame:
    return enrich(r["telemetry"], r["orders"], r["failures"], r["maintenance"], r["demand"])


def i1_enriched(spark, sf_dir):
    return _enriched(_roles(spark, sf_dir))


def m1_machine_health(spark, sf_dir):
    return machine_health(_enriched(_roles(spark, sf_dir)))


def m2a_pre_failure_state(spark, sf_dir):
    r = _roles(spark, sf_dir)
    return pre_failure_state(r["failures"], _enriched(r))


def m2b_post_failure_maintenance(spark, sf_dir):
    return post_failure_maintenance(_roles(spark, sf_dir)["maintenance"])


def m2_failure_analysis(spark, sf_dir):
    r = _roles(spark, sf_dir)
    return failure_analysis(r["failures"], _enriched(r), r["maintenance"])


def m3a_monthly_orders(spark, sf_dir):
    apply_sql_defaults(spark)
    return monthly_orders(roles.orders(spark, sf_dir))


def m3b_monthly_demand(spark, sf_dir):
    apply_sql_defaults(spark)
    return monthly_demand(roles.demand(spark, sf_dir))


def m3_production_performance(spark, sf_dir):
    apply_sql_defaults(spark)
    return production_performance(roles.orders(spark, sf_dir), roles.demand(spark, sf_dir))


class _Marts:
    """The three marts over the role views, each built on first use."""

    def __init__(self, spark, sf_dir):
        self.r = _roles(spark, sf_dir)
        self._e = None
        self._built: dict[str, DataFrame] = {}

    def _enriched(self) -> DataFrame:
        if self._e is None:
            self._e = _enriched(self.r)
        return self._e

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            r = self.r
            if name == "health":
                self._built[name] = machine_health(self._enriched())
            elif name == "failures":
                self._built[name] = failure_analysis(r["failures"], self._enriched(), r["maintenance"])
            elif name == "production":
                self._built[name] = production_performance(r["orders"], r["demand"])
            else:
                raise KeyError(name)
        return self._built[name]

    def all(self) -> dict[str, DataFrame]:
        return {k: self[k] for k in ("health", "failures", "production")}


def _marts(spark, sf_dir) -> _Marts:
    return _Marts(spark, sf_dir)


# -- operator-level queries ---------------------------------------------------


def j5_interval_join(spark, sf_dir):
    """Day-bucketed J5: (failure, reading) pairs in the 24 h before the failure."""
    r = _roles(spark, sf_dir)
    anchors = r["failures"].select("failure_id", "machine_id", "occurred_at")
    points = r["telemetry"].select("machine_id", "recorded_at", "recording_date")
    return window_join(
        anchors, points, ["machine_id"], "occurred_at", "recorded_at", "recording_date", 24
    ).select("failure_id", "machine_id", "occurred_at", "recorded_at")


def w1_rolling(spark, sf_dir):
    daily = daily_machine_health(_enriched(_roles(spark, sf_dir)))
    return with_status(daily).select(
        "machine_id", "recording_date", "composite_health_score", "rolling_7d_health"
    )


def x1_ns_timestamp(spark, sf_dir):
    """Epoch-ns INT64 -> TIMESTAMP, exact; sub-microsecond digits vary per row."""
    apply_sql_defaults(spark)
    e = roles.read_table(spark, sf_dir, "events")
    ns = e.select("event_id", (timestamp_to_ns("ts") + F.col("event_id") % 1000).alias("ts_ns"))
    return ns.select("event_id", "ts_ns", ns_to_timestamp("ts_ns").cast("timestamp_ntz").alias("ts_exact"))


def x6_minutes(spark, sf_dir):
    """Whole minutes between a reading and the half hour of its hour (either sign)."""
    apply_sql_defaults(spark)
    e = roles.read_table(spark, sf_dir, "events")
    anchor = F.date_trunc("hour", "ts") + F.expr("INTERVAL 30 MINUTES")
    return e.select("event_id", minutes_between(F.col("ts"), anchor).alias("minutes"))


def x7_elapsed(spark, sf_dir):
    """Elapsed minutes (whole seconds / 60, double) since the start of the day."""
    apply_sql_defaults(spark)
    e = roles.read_table(spark, sf_dir, "events")
    return e.select(
        "event_id", elapsed_minutes(F.col("ts"), F.date_trunc("day", "ts")).alias("elapsed_minutes")
    )


def v4_is_delayed(spark, sf_dir):
    o = _roles(spark, sf_dir)["orders"]
    return o.select("order_id", "is_completed", "duration_variance_minutes", "is_delayed")


# -- raw path: declared-schema raw tables -> clean (T1-T5) -> stage (V1-V5) -----

# Years of the guard: a timestamp outside fails the query.
RAW_YEARS = (1990, 2030)


def _ntz(df: DataFrame) -> DataFrame:
    """Session-zone TIMESTAMP columns as TIMESTAMP_NTZ (UTC wall clock) for comparison."""
    return df.select(
        [
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.simpleString() == "timestamp" else f.name
            for f in df.schema.fields
        ]
    )


def _clean_query(name: str):
    def run(spark, sf_dir):
        apply_sql_defaults(spark)
        raw = raw_roles.RAW_ROLES[name](spark, sf_dir)
        return _ntz(CLEANERS[name](raw, RAW_YEARS).drop("loaded_at"))

    return run


def _stage_query(name: str):
    def run(spark, sf_dir):
        apply_sql_defaults(spark)
        raw = raw_roles.RAW_ROLES[name](spark, sf_dir)
        return _ntz(STAGERS[name](CLEANERS[name](raw, RAW_YEARS)).drop("loaded_at"))

    return run


# -- data quality ---------------------------------------------------------------


class _ModelTables(Mapping):
    """Staged role views, enriched table and marts by model name, built on first use."""

    _NAMES = (
        "stg_telemetry", "stg_failures", "stg_maintenance", "stg_orders", "stg_demand",
        "int_telemetry_enriched", "mart_machine_health", "mart_failure_analysis",
        "mart_production_performance",
    )

    def __init__(self, spark, sf_dir):
        self.marts = _Marts(spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        m = self.marts
        if name.startswith("stg_"):
            return m.r[name[4:]]
        return {
            "int_telemetry_enriched": m._enriched,
            "mart_machine_health": lambda: m["health"],
            "mart_failure_analysis": lambda: m["failures"],
            "mart_production_performance": lambda: m["production"],
        }[name]()

    def __iter__(self):
        return iter(self._NAMES)

    def __len__(self):
        return len(self._NAMES)


def _model_tables(spark, sf_dir) -> Mapping:
    return _ModelTables(spark, sf_dir)


def _declared(kind: str) -> dict:
    return {
        t: [c for c in checks if c[1] == kind]
        for t, checks in quality.DECLARED_MODEL_TESTS.items()
        if any(c[1] == kind for c in checks)
    }


def _with_readings_once(tables: Mapping, declared: dict) -> list[DataFrame]:
    """Row checks of the enriched readings and of M1 from one pass over the readings.

    The readings' violations are counted per machine-day, beside M1's own
    aggregates, and summed with M1's checks.
    """
    readings, daily = "int_telemetry_enriched", "mart_machine_health"
    own = {f"__reading_check_{i}": (c, quality.violations(c)) for i, c in enumerate(declared[readings])}
    m1 = with_status(daily_machine_health(tables[readings], {k: v for k, (_, v) in own.items()}))
    checks = [(readings, c, F.coalesce(F.sum(k), F.lit(0))) for k, (c, _) in own.items()]
    checks += [(daily, c, quality.violations(c)) for c in declared[daily]]
    return [quality.aggregate_checks(m1, checks)]


def _quality_query(kind: str):
    def run(spark, sf_dir):
        tables = _model_tables(spark, sf_dir)
        declared = _declared(kind)
        parts = []
        if kind == "not_null":
            parts = _with_readings_once(tables, declared)
            declared = {t: c for t, c in declared.items() if t not in ("int_telemetry_enriched", "mart_machine_health")}
        parts.append(quality.run_declared(tables, declared))
        return reduce(DataFrame.unionByName, parts)

    run.__name__ = f"d_{kind}"
    return run


def _raw_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The cleaned raw tables over the test data, as the source tests see them."""
    apply_sql_defaults(spark)
    return {name: clean(raw_roles.RAW_ROLES[name](spark, sf_dir), name) for name in raw_roles.RAW_ROLES}


def d_source_tests(spark, sf_dir):
    """The 14 declared tests of the five sources."""
    return quality.run_declared(_raw_tables(spark, sf_dir), quality.DECLARED_SOURCE_TESTS)


def d5_freshness(spark, sf_dir):
    """Freshness of the staged readings' own time."""
    t = _roles(spark, sf_dir)["telemetry"]
    return quality.freshness_check(t, "stg_telemetry", "recorded_at", FRESHNESS_AS_OF, 400)


def d5_source_freshness(spark, sf_dir):
    """The declared check: the telemetry load stamp, here a fixed one so that it can be compared."""
    t = _raw_tables(spark, sf_dir)["telemetry"].withColumn("loaded_at", F.lit(LOAD_STAMP).cast("timestamp"))
    field, days = quality.FRESHNESS["telemetry"]
    return quality.freshness_check(t, "telemetry", field, FRESHNESS_AS_OF, days)


def d6_row_count(spark, sf_dir):
    r = _roles(spark, sf_dir)
    parts = [
        quality.row_count_check(r[name], f"stg_{name}", quality.EXPECTED_ROWS[name])
        for name in ("telemetry", "failures", "maintenance", "orders", "demand")
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


FRESHNESS_AS_OF = "2000-01-01 00:00:00"
LOAD_STAMP = "1998-11-01 00:00:00"


# -- dashboard --------------------------------------------------------------------


def q1_kpi_scorecards(spark, sf_dir):
    m = _marts(spark, sf_dir)
    return dashboard.kpi_scorecards(m["health"], m["failures"], m["production"])


def q2_health_trend(spark, sf_dir):
    return dashboard.health_trend(_marts(spark, sf_dir)["health"])


def q3_tons_vs_forecast(spark, sf_dir):
    return dashboard.tons_vs_forecast(_marts(spark, sf_dir)["production"])


def q4_rolling_health(spark, sf_dir):
    return dashboard.rolling_health(_marts(spark, sf_dir)["health"])


def q5_status_distribution(spark, sf_dir):
    return dashboard.status_distribution(_marts(spark, sf_dir)["health"])


def q6_failure_frequency(spark, sf_dir):
    return dashboard.failure_frequency(_marts(spark, sf_dir)["failures"])


def q7_pressure_correlation(spark, sf_dir):
    m = _marts(spark, sf_dir)
    return dashboard.pressure_correlation(m["health"], m["production"])


def q8_delay_hotspots(spark, sf_dir):
    return dashboard.delay_hotspots(_marts(spark, sf_dir)["production"])


# Slicer values of the q9 example (a dashboard filter is the feature here).
Q9_SLICE = {"start": "1999-01-08", "end": "1999-01-21", "failure_category": ["bearing", "lube"]}


def q9_sliced_failures(spark, sf_dir):
    f = _marts(spark, sf_dir)["failures"]
    return dashboard.slice_mart(f, "occurrence_date", **Q9_SLICE)


Q9_HEALTH_SLICE = {"start": "1999-01-08", "end": "1999-01-21", "health_status": ["warning", "critical"]}
Q9_PRODUCTION_SLICE = {"start": "1995-01-01", "end": "1996-12-31", "market": ["1-URGENT"], "steel_grade": None}


def q9_sliced_health(spark, sf_dir):
    return dashboard.slice_mart(_marts(spark, sf_dir)["health"], "recording_date", **Q9_HEALTH_SLICE)


def q9_sliced_production(spark, sf_dir):
    return dashboard.slice_mart(_marts(spark, sf_dir)["production"], "month_date", **Q9_PRODUCTION_SLICE)


def q10_mart_row_counts(spark, sf_dir):
    return dashboard.mart_row_counts(_marts(spark, sf_dir).all())


def q11_machines_needing_action(spark, sf_dir):
    return dashboard.machines_needing_action(_marts(spark, sf_dir)["health"])


QUERIES: dict[str, Query] = {
    "i1_enriched": i1_enriched,
    "m1_machine_health": m1_machine_health,
    "m2a_pre_failure_state": m2a_pre_failure_state,
    "m2b_post_failure_maintenance": m2b_post_failure_maintenance,
    "m2_failure_analysis": m2_failure_analysis,
    "m3a_monthly_orders": m3a_monthly_orders,
    "m3b_monthly_demand": m3b_monthly_demand,
    "m3_production_performance": m3_production_performance,
    "j5_interval_join": j5_interval_join,
    "w1_rolling": w1_rolling,
    "x1_ns_timestamp": x1_ns_timestamp,
    "x6_minutes": x6_minutes,
    "x7_elapsed": x7_elapsed,
    "v4_is_delayed": v4_is_delayed,
    "t1_clean_telemetry": _clean_query("telemetry"),
    "t2_clean_failures": _clean_query("failures"),
    "t3_clean_maintenance": _clean_query("maintenance"),
    "t4_clean_orders": _clean_query("orders"),
    "t5_clean_demand": _clean_query("demand"),
    "v1_stg_telemetry": _stage_query("telemetry"),
    "v2_stg_failures": _stage_query("failures"),
    "v3_stg_maintenance": _stage_query("maintenance"),
    "v4_stg_orders": _stage_query("orders"),
    "v5_stg_demand": _stage_query("demand"),
    "d1_not_null": _quality_query("not_null"),
    "d2_unique": _quality_query("unique"),
    "d3_accepted_values": _quality_query("accepted_values"),
    "d4_accepted_range": _quality_query("accepted_range"),
    "d5_freshness": d5_freshness,
    "d6_row_count": d6_row_count,
    "d_source_tests": d_source_tests,
    "d5_source_freshness": d5_source_freshness,
    "q1_kpi_scorecards": q1_kpi_scorecards,
    "q2_health_trend": q2_health_trend,
    "q3_tons_vs_forecast": q3_tons_vs_forecast,
    "q4_rolling_health": q4_rolling_health,
    "q5_status_distribution": q5_status_distribution,
    "q6_failure_frequency": q6_failure_frequency,
    "q7_pressure_correlation": q7_pressure_correlation,
    "q8_delay_hotspots": q8_delay_hotspots,
    "q9_sliced_failures": q9_sliced_failures,
    "q9_sliced_health": q9_sliced_health,
    "q9_sliced_production": q9_sliced_production,
    "q10_mart_row_counts": q10_mart_row_counts,
    "q11_machines_needing_action": q11_machines_needing_action,
    **stored.QUERIES,
}
