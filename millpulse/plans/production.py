"""M3: monthly production performance against the plant-wide demand forecast.

M3a aggregates started orders by (month, machine, market, grade) with partial
aggregation; M3b reduces demand to one row per month.  M3 joins them with USING
semantics on ``month_date``, broadcasting M3b: being
grouped by month it has at most one row per calendar month in the data (120
rows for ten years), a bound that holds whatever the input size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpulse.functions import month_start, round_half_up, safe_divide
from millpulse.operators.joins import lookup_join

PRODUCTION_COLUMNS = [
    "month_date", "machine_id", "market", "steel_grade",
    "total_orders", "completed_orders", "delayed_orders", "incomplete_orders",
    "completion_rate", "delay_rate", "total_tons_produced", "avg_order_weight_tons",
    "avg_duration_variance_min", "avg_demand_index", "avg_rush_factor",
    "monthly_expected_tons", "avg_trend_index", "avg_seasonal_index",
    "production_vs_forecast_ratio",
]


def monthly_orders(orders: DataFrame) -> DataFrame:
    """M3a. ``delay_rate`` divides by completed orders; tons sum every started order."""
    n = F.count(F.lit(1))
    completed = F.count_if("is_completed")
    delayed = F.count_if("is_delayed")
    return (
        orders.where(F.col("machine_id").isNotNull())
        .groupBy(
            month_start("planned_date").alias("month_date"), "machine_id", "market", "steel_grade"
        )
        .agg(
            n.alias("total_orders"),
            completed.alias("completed_orders"),
            delayed.alias("delayed_orders"),
            F.count_if(~F.col("is_completed")).alias("incomplete_orders"),
            round_half_up(safe_divide(completed, n), 4).alias("completion_rate"),
            round_half_up(safe_divide(delayed, completed), 4).alias("delay_rate"),
            round_half_up(F.sum("total_weight_tons"), 2).alias("total_tons_produced"),
            round_half_up(F.avg("total_weight_tons"), 2).alias("avg_order_weight_tons"),
            round_half_up(F.avg("duration_variance_minutes"), 1).alias("avg_duration_variance_min"),
            round_half_up(F.avg("demand_index_at_intake"), 4).alias("avg_demand_index"),
            round_half_up(F.avg("rush_factor_at_intake"), 4).alias("avg_rush_factor"),
        )
    )


def monthly_demand(demand: DataFrame) -> DataFrame:
    """Plant-wide forecast per month."""
    return demand.groupBy(month_start("demand_date").alias("month_date")).agg(
        round_half_up(F.sum("expected_total_tons"), 2).alias("monthly_expected_tons"),
        round_half_up(F.avg("trend_index"), 4).alias("avg_trend_index"),
        round_half_up(F.avg("seasonal_index"), 4).alias("avg_seasonal_index"),
    )


def production_performance(orders: DataFrame, demand: DataFrame) -> DataFrame:
    """M3: the ratio is a group's tons over the whole plant's monthly forecast."""
    o = monthly_orders(orders)
    d = monthly_demand(demand).withColumnRenamed("month_date", "demand_month")
    out = lookup_join(o, d, "month_date", "demand_month", broadcast=True)  # one row per month
    return out.withColumn(
        "production_vs_forecast_ratio",
        round_half_up(safe_divide("total_tons_produced", "monthly_expected_tons"), 4),
    ).select(*PRODUCTION_COLUMNS)
