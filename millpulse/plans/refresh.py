"""Which partitions of the models a change of the raw tables reaches, and their rebuild.

``touched_since`` compares the raw snapshot that the models were built from with the
current one: days of telemetry whose rows differ, and rows of the small tables
that were added, lost or changed.  From there

* enriched: those days, days of forecasts that changed, and days with a reading
  that refers to a changed order, failure or maintenance;
* M1: the days of the enriched table, and days with one of the six next rows of a
  machine after them (the rolling mean counts rows), lost rows included;
* M2: days of failures that changed, that had readings or maintenance changed
  within their reach (the readings of a day reach failures of this day and the next);
* M3: months of changed orders and forecasts.

All else keeps its files.  What is collected are days and months.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millpulse.functions import month_start
from millpulse.operators.enrich import enrich
from millpulse.operators.staging import STAGERS
from millpulse.plans.failures import failure_analysis
from millpulse.plans.health import ROLLING_ROWS, daily_machine_health, machine_health, with_status
from millpulse.plans.production import production_performance
from millpulse.plans.steps import run_steps
from millpulse.sinks.snapshots import Snapshot, SnapshotStore

#: What each model waits for.
NEEDS = {
    "int_telemetry_enriched": (),
    "mart_machine_health": ("int_telemetry_enriched",),
    "mart_failure_analysis": ("int_telemetry_enriched",),
    "mart_production_performance": (),
}
#: Small tables: key, and the reading's column that refers to it.
REFERENCES = {"orders": ("order_id", "active_order_id"), "failures": ("failure_id", "last_failure_id"), "maintenance": ("maintenance_id", "active_maintenance_id")}

Days = frozenset


def part(column: str, value: dt.date | None) -> str:
    """The folder of a date partition."""
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value.isoformat()}"


def _in(column: Column, values: Iterable[dt.date | None]) -> Column:
    known = [F.lit(v) for v in values if v is not None]
    out = column.isin(*known) if known else F.lit(False)
    return F.coalesce(out, F.lit(False)) | column.isNull() if None in values else F.coalesce(out, F.lit(False))


def _dates(df: DataFrame) -> set:
    return {r[0] for r in df.distinct().collect()}


def _prints(pair: list[DataFrame], key: str) -> set:
    """Values of ``key`` whose rows differ between two tables, by their number and the sum of their hashes."""
    sides = [p.withColumn("__side", F.lit(side)) for side, p in zip((1, -1), pair, strict=True)]
    columns = [c for c in pair[0].columns if c != key]
    h = F.xxhash64(*columns)
    # the halves of the hashes are summed, each exact in a long up to 2 ** 32 rows
    halves = {"high": F.shiftright(h, 32), "low": F.shiftright(F.shiftleft(h, 32), 32)}
    sums = [F.sum(v * F.col("__side")).alias(k) for k, v in halves.items()]
    rows = sides[0].unionByName(sides[1]).groupBy(key).agg(F.sum("__side").alias("n"), *sums)
    return _dates(rows.where("n <> 0 or high <> 0 or low <> 0").select(key))


@dataclass(frozen=True)
class Touched:
    """Days of readings and of failures, and months, that a change reaches."""

    readings: Days
    failures: Days
    months: Days


def _changed_parts(old: Snapshot, new: Snapshot, table: str) -> tuple[set[str], set[str]]:
    a, b = old.parts(table), new.parts(table)
    return {p for p in a if b.get(p) != a[p]}, {p for p in b if a.get(p) != b[p]}


def touched_since(spark: SparkSession, store: SnapshotStore, new: Snapshot, models: Snapshot, staged: dict[str, DataFrame]) -> Touched | None:
    """None where the models have to be built whole: never built, or from a snapshot that is gone or of other columns."""
    version = models.meta.get("raw_version")
    if version is None or version not in store.versions():
        return None
    old = store.at(version)
    if any(json.loads(new.schemas[t]) != json.loads(old.schemas.get(t, "null")) for t in new.schemas):
        return None

    def both(name: str) -> tuple[DataFrame, DataFrame] | None:
        """The staged rows of partitions that differ, before and after."""
        before, after = _changed_parts(old, new, name)
        if not before and not after:
            return None
        schema = new.schema(name)
        rows = (STAGERS[name](store.read_parts(name, s, p, schema)) for s, p in ((old, before), (new, after)))
        a, b = (r.drop("loaded_at") for r in rows)
        return a, b

    def differing(name: str) -> DataFrame | None:
        """Rows that one side has more often; None where a reload brought the same rows."""
        pair = both(name)
        if pair is None or len(_prints([p.select(F.lit(0).alias("all"), "*") for p in pair], "all")) == 0:
            return None
        return pair[0].exceptAll(pair[1]).unionByName(pair[1].exceptAll(pair[0]))

    small = ("orders", "failures", "maintenance", "demand")
    found = run_steps(
        spark,
        {"telemetry": ((), lambda done: _prints(pair, "recording_date") if (pair := both("telemetry")) is not None else set())}
        | {name: ((), lambda done, name=name: differing(name)) for name in small},
        at_once=1 + len(small),
    )
    days: set = set(found["telemetry"])
    telemetry = staged["telemetry"]
    changed = {name: found[name] for name in small if found[name] is not None}
    for name, (key, reference) in REFERENCES.items():
        if name in changed:
            keys = changed[name].select(F.col(key).alias(reference)).distinct()
            days |= _dates(telemetry.select("recording_date", reference).join(keys, reference, "left_semi").select("recording_date"))
    if "demand" in changed:
        days |= _dates(changed["demand"].select("demand_date"))
    days.discard(None)

    failures: set = set()
    if "failures" in changed:
        failures |= _dates(changed["failures"].select("occurrence_date"))
        failures |= _dates(staged["failures"].join(changed["failures"].select("failure_id").distinct(), "failure_id", "left_semi").select("occurrence_date"))
    reach = days | {d + dt.timedelta(days=1) for d in days}
    if reach:
        failures |= _dates(staged["failures"].where(_in(F.col("occurrence_date"), reach)).select("occurrence_date"))
    if "maintenance" in changed:
        linked = changed["maintenance"].select(F.col("linked_failure_id").alias("failure_id")).distinct()
        failures |= _dates(staged["failures"].join(linked, "failure_id", "left_semi").select("occurrence_date"))
    known: set = set()
    while failures - known:
        # rows of one id share what is counted for it (ids are unique but for faults, so this is one round)
        known = set(failures)
        ids = staged["failures"].where(_in(F.col("occurrence_date"), failures)).select("failure_id").distinct()
        failures |= _dates(staged["failures"].join(ids, "failure_id", "left_semi").select("occurrence_date"))

    months: set = set()
    if "orders" in changed:
        months |= _dates(changed["orders"].select(month_start("planned_date")))
    if "demand" in changed:
        months |= _dates(changed["demand"].select(month_start("demand_date")))
    return Touched(Days(days), Days(failures), Days(months))


def next_rows(stored: DataFrame, now: DataFrame, days: Iterable[dt.date]) -> set:
    """Days with a row among a machine's six next after a row of ``days``, of the stored or the new rows, or in them."""
    rows = stored.select("machine_id", "recording_date").union(now.select("machine_id", "recording_date"))
    rows = rows.groupBy("machine_id", "recording_date").agg(F.max(_in(F.col("recording_date"), days).cast("int")).alias("hit"))
    w = Window.partitionBy("machine_id").orderBy("recording_date").rowsBetween(-(ROLLING_ROWS - 1), Window.currentRow)
    return _dates(rows.withColumn("hit", F.max("hit").over(w)).where("hit = 1").select("recording_date"))


class Build:
    """The models' rows to write: whole tables, or the partitions that ``touched`` reaches."""

    def __init__(self, store: SnapshotStore, base: Snapshot, staged: dict[str, DataFrame], touched: Touched | None):
        self.store, self.base, self.staged, self.touched = store, base, staged, touched

    def _enriched(self, done: dict) -> DataFrame:
        change = done["int_telemetry_enriched"]
        return self.store.read("int_telemetry_enriched", self.base.after([change]) if change else self.base)

    def table(self, name: str, done: dict) -> tuple[DataFrame, set | None] | None:
        """(rows, partition values they replace; None for all), or None where nothing is to be done."""
        make = {
            "int_telemetry_enriched": self._make_enriched,
            "mart_machine_health": self._make_health,
            "mart_failure_analysis": self._make_failures,
            "mart_production_performance": self._make_production,
        }
        return make[name](done)

    def _make_enriched(self, done: dict):
        s = self.staged
        readings = s["telemetry"]
        if self.touched is not None:
            if not self.touched.readings:
                return None
            readings = readings.where(_in(F.col("recording_date"), self.touched.readings))
        out = enrich(readings, s["orders"], s["failures"], s["maintenance"], s["demand"])
        return out, None if self.touched is None else set(self.touched.readings)

    def _make_health(self, done: dict):
        enriched = self._enriched(done)
        if self.touched is None:
            return machine_health(enriched), None
        days = self.touched.readings
        if not days:
            return None
        stored = self.store.read("mart_machine_health", self.base)
        new = enriched.where(_in(F.col("recording_date"), days))
        kept = stored.where(~_in(F.col("recording_date"), days)).drop("health_status", "rolling_7d_health")
        reached = set(days) | next_rows(stored, new, days)
        rows = with_status(kept.unionByName(daily_machine_health(new)))
        return rows.where(_in(F.col("recording_date"), reached)), reached

    def _make_failures(self, done: dict):
        enriched, s = self._enriched(done), self.staged
        if self.touched is None:
            return failure_analysis(s["failures"], enriched, s["maintenance"]), None
        days = self.touched.failures
        if not days:
            return None
        around = days | {d - dt.timedelta(days=1) for d in days}
        failures = s["failures"].where(_in(F.col("occurrence_date"), days))
        return failure_analysis(failures, enriched.where(_in(F.col("recording_date"), around)), s["maintenance"]), set(days)

    def _make_production(self, done: dict):
        orders, demand = self.staged["orders"], self.staged["demand"]
        if self.touched is None:
            return production_performance(orders, demand), None
        months = self.touched.months
        if not months:
            return None
        orders = orders.where(_in(month_start("planned_date"), months))
        return production_performance(orders, demand.where(_in(month_start("demand_date"), months))), set(months)
