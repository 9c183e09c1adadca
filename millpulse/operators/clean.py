"""Type and validate the five raw tables.

``clean(df, name)`` is driven by a table's ``Spec``: which columns are epochs
(INT64 nanoseconds, converted exactly by ``ns_to_timestamp``), which are 0/1
flags, and which columns are derived from the typed ones.  Rows missing a key
(``schemas.KEYS``) are dropped.  Everything is one filter and one projection.

``years=(first, last)`` is an optional guard: a timestamp or date outside these
calendar years fails the query (``raise_error``).  It is off by default; the
yearly load judges its files as a whole instead, by what it observes while it
writes them (``year_metrics``), so that a single odd date does not stop a year.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpulse.functions import elapsed_minutes, flag, ns_to_timestamp
from millpulse.sources.schemas import KEYS

Typed = Callable[[str], Column]


@dataclass(frozen=True)
class Spec:
    epochs: tuple[str, ...] = ()
    #: output column -> 0/1 source column
    flags: dict[str, str] = field(default_factory=dict)
    #: output column -> expression of typed columns and of the derived ones before it
    derived: dict[str, Callable[[Typed], Column]] = field(default_factory=dict)
    #: stored DATE columns that the year guard covers as well
    dates: tuple[str, ...] = ()


def _date_of(ts: str) -> Callable[[Typed], Column]:
    return lambda c: F.to_date(c(ts))


def _year_of(date: str) -> Callable[[Typed], Column]:
    return lambda c: F.year(c(date)).cast("bigint")


SPECS = {
    "telemetry": Spec(
        epochs=("timestamp",),
        flags={
            "is_running": "is_running",
            "is_weekend": "is_weekend",
            "is_anomaly": "label_anomaly",
            "fail_in_24h": "label_failure_in_24h",
            "fail_in_72h": "label_failure_in_72h",
        },
        derived={"date": _date_of("timestamp")},
    ),
    "failures": Spec(
        epochs=("timestamp_occurrence",),
        flags={"is_weekend": "is_weekend"},
        derived={"date": _date_of("timestamp_occurrence"), "year": _year_of("date")},
    ),
    "maintenance": Spec(
        epochs=("timestamp_start",),
        derived={"date": _date_of("timestamp_start"), "year": _year_of("date")},
    ),
    "orders": Spec(
        epochs=("timestamp_planned", "timestamp_start", "timestamp_end"),
        flags={"is_weekend_intake": "is_weekend_intake"},
        derived={
            "date_planned": _date_of("timestamp_planned"),
            "date_start": _date_of("timestamp_start"),
            "year": _year_of("date_planned"),
            "actual_duration_minutes": lambda c: elapsed_minutes(c("timestamp_end"), c("timestamp_start")),
            "duration_variance_minutes": lambda c: c("actual_duration_minutes") - c("duration_minutes_planned"),
        },
    ),
    "demand": Spec(flags={"is_weekend": "is_weekend"}, derived={"year": _year_of("date")}, dates=("date",)),
}


def _guarded(value: Column, name: str, years: tuple[int, int] | None) -> Column:
    if years is None:
        return value
    message = F.concat(F.lit(f"{name} outside {years[0]}-{years[1]}: "), value.cast("string"), F.lit(" (is the file in nanoseconds?)"))
    return F.when(value.isNull() | F.year(value).between(*years), value).otherwise(F.raise_error(message))


def has_keys(name: str) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in KEYS[name]])


def clean(df: DataFrame, name: str, years: tuple[int, int] | None = None) -> DataFrame:
    """The typed table: stored columns in their order, then derived ones, then the load stamp."""
    spec = SPECS[name]
    typed = {c: _guarded(ns_to_timestamp(c), c, years) for c in spec.epochs}
    typed |= {c: _guarded(F.col(c), c, years) for c in spec.dates}
    typed |= {out: flag(source) for out, source in spec.flags.items()}
    for out, make in spec.derived.items():
        typed[out] = make(lambda c: typed.get(c, F.col(c)))
    stored = [typed.get(c, F.col(c)).alias(c) for c in df.columns]
    added = [typed[c].alias(c) for c in (*spec.derived, *spec.flags) if c not in df.columns]
    return df.where(has_keys(name)).select(*stored, *added, F.current_timestamp().alias("loaded_at"))


def year_metrics(name: str, first: int, last: int) -> dict[str, Column]:
    """Aggregates of a cleaned table, two for each timestamp or date column: its values, and those outside the years."""
    spec = SPECS[name]
    out = {}
    for c in (*spec.epochs, *spec.dates):
        out[f"values.{c}"] = F.count(c)
        out[f"outside.{c}"] = F.count_if(~F.year(c).between(first, last))
    return out


def _cleaner(name: str) -> Callable[..., DataFrame]:
    def run(df: DataFrame, years: tuple[int, int] | None = None) -> DataFrame:
        return clean(df, name, years)

    return run


CLEANERS = {name: _cleaner(name) for name in SPECS}
