"""Q1-Q11: the dashboard's questions as aggregates over the three marts.

All inputs are the (small) mart tables; each query is one grouped aggregate
or projection.  Multi-metric answers are returned in long form
(``kpi, value``) built with unions of one-row aggregates, not cross joins.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpulse.functions import round_half_up, safe_divide


def _one(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.agg(value.cast("double").alias("value")).select(F.lit(name).alias("kpi"), "value")


def kpi_scorecards(health: DataFrame, failures: DataFrame, production: DataFrame) -> DataFrame:
    """Q1: average composite health, total failures, average completion rate."""
    return reduce(
        DataFrame.unionByName,
        [
            _one(health, "avg_composite_health", round_half_up(F.avg("composite_health_score"), 4)),
            _one(failures, "total_failures", F.count(F.lit(1))),
            _one(production, "avg_completion_rate", round_half_up(F.avg("completion_rate"), 4)),
        ],
    )


def health_trend(health: DataFrame) -> DataFrame:
    """Q2: plant-wide composite health per day."""
    return health.groupBy("recording_date").agg(
        round_half_up(F.avg("composite_health_score"), 4).alias("avg_composite_health"),
        F.count(F.lit(1)).alias("machines"),
    )


def tons_vs_forecast(production: DataFrame) -> DataFrame:
    """Q3: produced vs expected tons per month.  The forecast repeats on every
    group row of a month, so it is taken once (max), not summed."""
    return production.groupBy("month_date").agg(
        round_half_up(F.sum("total_tons_produced"), 2).alias("tons_produced"),
        F.max("monthly_expected_tons").alias("expected_tons"),
    )


def rolling_health(health: DataFrame) -> DataFrame:
    """Q4: rolling 7-reading-day health by machine."""
    return health.select(
        "machine_id", "recording_date", "composite_health_score", "rolling_7d_health", "health_status"
    )


def status_distribution(health: DataFrame) -> DataFrame:
    """Q5: days per health status and machine."""
    return health.groupBy("machine_id", "health_status").agg(F.count(F.lit(1)).alias("days"))


def failure_frequency(failures: DataFrame) -> DataFrame:
    """Q6: failures by category and root cause."""
    return failures.groupBy("failure_category", "root_cause").agg(
        F.count(F.lit(1)).alias("failures"),
        F.count_if("was_predicted").alias("predicted_failures"),
    )


def pearson(x, y) -> Column:
    """Sample Pearson correlation; NULL (not an ANSI divide-by-zero error) when
    either side is constant or there are fewer than two pairs."""
    x, y = F.col(x).cast("double"), F.col(y).cast("double")
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)  # pairwise-complete, like corr()
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def _correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """One row per pair, all from one aggregate over ``df``."""
    rows = [
        F.struct(
            F.lit(x).alias("pressure"),
            F.lit(y).alias("outcome"),
            round_half_up(pearson(x, y), 4).alias("correlation"),
            F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull()).alias("pairs"),
        )
        for x, y in pairs
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def pressure_correlation(health: DataFrame, production: DataFrame) -> DataFrame:
    """Q7: Pearson correlation of operational pressure with delays (monthly
    groups) and with failure-predicting readings (machine-days).  Each mart is
    aggregated once."""
    pressures = ("avg_demand_index", "avg_rush_factor")
    delays = _correlations(production, [(x, "delay_rate") for x in pressures])
    return delays.unionByName(_correlations(health, [(x, "readings_predicting_failure_24h") for x in pressures]))


def delay_hotspots(production: DataFrame) -> DataFrame:
    """Q8: delays per completed order by grade and market."""
    return production.groupBy("steel_grade", "market").agg(
        F.sum("delayed_orders").alias("delayed_orders"),
        F.sum("completed_orders").alias("completed_orders"),
        round_half_up(safe_divide(F.sum("delayed_orders"), F.sum("completed_orders")), 4).alias("delay_rate"),
    )


def slice_mart(
    df: DataFrame,
    date_col: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    **in_lists,
) -> DataFrame:
    """Dashboard slicers.  Date bounds are inclusive; every keyword
    ``column=[values]`` becomes an IN filter.  On a table partitioned by the
    date column the bounds prune partitions at the scan."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(date_col) >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (F.col(date_col) <= F.lit(end).cast("date"))
    for col, values in in_lists.items():
        if values is not None:
            cond = cond & F.col(col).isin(list(values))
    return df.where(cond)


def mart_row_counts(marts: dict[str, DataFrame]) -> DataFrame:
    """Q10: row count per mart."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("mart"), "row_count")
        for name, df in marts.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def machines_needing_action(health: DataFrame) -> DataFrame:
    """Q11: each machine's latest day, worst rolling health first."""
    latest = F.max_by(
        F.struct("recording_date", "composite_health_score", "rolling_7d_health", "health_status"),
        "recording_date",
    )
    return (
        health.groupBy("machine_id")
        .agg(latest.alias("s"))
        .select(
            "machine_id",
            F.col("s.recording_date").alias("latest_date"),
            F.col("s.composite_health_score").alias("composite_health_score"),
            F.col("s.rolling_7d_health").alias("rolling_7d_health"),
            F.col("s.health_status").alias("health_status"),
        )
        .orderBy(F.col("rolling_7d_health").asc_nulls_first(), "machine_id")
    )
