"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Rounding uses the same fixed-point route as ``round_half_up`` so both engines
round ties identically; DuckDB's HUGEINT counts and TIMESTAMP month starts
are cast back to BIGINT and DATE.
"""

from __future__ import annotations

from millpulse.sources.roles_sql import with_roles


def R(expr: str, n: int) -> str:
    return (
        f"(case when abs({expr}) < 1e27 then cast(round(cast({expr} as decimal(38,10)), {n}) as double) "
        f"else round({expr}, {n}) end)"
    )


def SD(num: str, den: str) -> str:
    return f"(cast({num} as double) / nullif(cast({den} as double), 0))"


def N(pred: str) -> str:
    """Rows for which a condition is true, as a conditional sum."""
    return f"cast(coalesce(sum(if({pred}, 1, 0)), 0) as bigint)"


# Readings with their context: each lookup is a scalar subquery that returns the
# looked-up row as a struct (NULL without a match).
I1 = """
looked_up as (
  select t.*,
    (select {'market': market, 'grade': steel_grade, 'tons': total_weight_tons, 'done': is_completed,
             'late': is_delayed, 'variance': duration_variance_minutes}
     from r_orders where order_id = t.active_order_id) as ord,
    (select {'category': failure_category, 'cause': root_cause, 'severity': severity_level}
     from r_failures where failure_id = t.last_failure_id) as fail,
    (select {'planned': is_planned, 'minutes': duration_minutes}
     from r_maintenance where maintenance_id = t.active_maintenance_id) as maint,
    (select {'tons': expected_total_tons, 'seasonal': seasonal_index}
     from r_demand where demand_date = t.recording_date) as forecast
  from r_telemetry as t
),
i1 as (
  select recorded_at, recording_date, machine_id, shift_id, status, is_running, is_weekend, is_anomaly,
    failure_predicted_24h, failure_predicted_72h, predicted_failure_type,
    bearing_temp_c, vibration_rms, motor_torque_nm, load_index,
    bearing_health, lube_health, align_health, motor_health,
    cumulative_op_hours, op_hours_since_lube, op_hours_since_calib, op_hours_since_bearing, op_hours_since_major,
    demand_index, rush_factor, maintenance_deferral,
    active_order_id, ord.market as order_market, ord.grade as order_steel_grade, ord.tons as order_weight_tons,
    ord.done as order_is_completed, ord.late as order_is_delayed, ord.variance as order_duration_variance_min,
    last_failure_id, fail.category as failure_category, fail.cause as failure_root_cause,
    fail.severity as failure_severity,
    active_maintenance_id, active_maintenance_type, maint.planned as maint_is_planned,
    maint.minutes as maint_duration_minutes,
    forecast.tons as daily_expected_tons, forecast.seasonal as daily_seasonal_index
  from looked_up
)"""

# (output, aggregate, digits) of a machine-day
_DAILY = [
    ("availability_rate", SD(N("is_running"), "count(*)"), 4),
    ("anomaly_rate", SD(N("is_anomaly"), "count(*)"), 4),
    ("avg_bearing_health", "avg(bearing_health)", 4),
    ("avg_lube_health", "avg(lube_health)", 4),
    ("avg_align_health", "avg(align_health)", 4),
    ("avg_motor_health", "avg(motor_health)", 4),
    ("composite_health_score", "(avg(bearing_health) + avg(lube_health) + avg(align_health) + avg(motor_health)) / 4", 4),
    ("avg_bearing_temp_c", "avg(bearing_temp_c)", 2),
    ("avg_vibration_rms", "avg(vibration_rms)", 4),
    ("avg_motor_torque_nm", "avg(motor_torque_nm)", 2),
    ("avg_load_index", "avg(load_index)", 4),
    ("avg_demand_index", "avg(demand_index)", 4),
    ("avg_rush_factor", "avg(rush_factor)", 4),
    ("avg_maintenance_deferral", "avg(maintenance_deferral)", 4),
    ("expected_tons_that_day", "avg(daily_expected_tons)", 2),
]

# The rolling mean as a self-join of numbered days: a day and the six rows before it.
M1 = f"""
numbered as (
  select machine_id, recording_date,
    row_number() over (partition by machine_id order by recording_date) as nth,
    count(*) as total_readings,
    {N('is_running')} as running_readings,
    {N('is_anomaly')} as anomaly_readings,
    {N('failure_predicted_24h')} as readings_predicting_failure_24h,
    {N('order_is_delayed')} as delayed_order_readings,
    max(cumulative_op_hours) as cumulative_op_hours, max(op_hours_since_lube) as op_hours_since_lube,
    max(op_hours_since_bearing) as op_hours_since_bearing, max(op_hours_since_major) as op_hours_since_major,
    {", ".join(f"{R(expr, n)} as {name}" for name, expr, n in _DAILY)}
  from i1 group by machine_id, recording_date
),
rolling as (
  select a.machine_id, a.nth, {R('avg(b.composite_health_score)', 4)} as rolling_7d_health
  from numbered a join numbered b on b.machine_id = a.machine_id and b.nth > a.nth - 7 and b.nth <= a.nth
  group by a.machine_id, a.nth
),
m1 as (
  select numbered.* exclude (nth), rolling_7d_health,
    if(composite_health_score >= 0.80, 'healthy', if(composite_health_score >= 0.60, 'warning', 'critical')) as health_status
  from numbered left join rolling using (machine_id, nth)
)"""

_PRIOR = [
    ("bearing_health", "avg_bearing_health_24h_prior"),
    ("lube_health", "avg_lube_health_24h_prior"),
    ("align_health", "avg_align_health_24h_prior"),
    ("motor_health", "avg_motor_health_24h_prior"),
    ("maintenance_deferral", "avg_maint_deferral_24h_prior"),
    ("demand_index", "avg_demand_24h_prior"),
    ("rush_factor", "avg_rush_24h_prior"),
]

# The day before each failure and its maintenance as lateral subqueries: one row
# each for every failure, emptied where nothing was found.
M2 = f"""
before as (
  select r_failures.failure_id, found.* from r_failures, lateral (
    select count(*) as readings, {N('failure_predicted_24h')} as readings_that_predicted_failure,
      {", ".join(f"{R(f'avg({src})', 4)} as {name}" for src, name in _PRIOR)}
    from i1 where i1.machine_id = r_failures.machine_id
      and i1.recorded_at between r_failures.occurred_at - interval 1 day and r_failures.occurred_at - interval 1 microsecond
  ) as found
),
m2a as (select * exclude (readings) from before where readings > 0),
m2b as (
  select distinct linked_failure_id as failure_id,
    min(started_at) over linked as first_maintenance_after,
    cast(sum(duration_minutes) over linked as bigint) as total_maint_minutes_after,
    count(*) over linked as maintenance_events_after
  from r_maintenance where linked_failure_id is not null
  window linked as (partition by linked_failure_id)
),
m2 as (
  select r_failures.* exclude (maintenance_deferral),
    maintenance_deferral as maint_deferral_at_failure,
    m2a.* exclude (failure_id),
    m2a.readings_that_predicted_failure > 0 as was_predicted,
    m2b.* exclude (failure_id),
    if(first_maintenance_after < occurred_at, -1, 1)
      * (abs(epoch_us(first_maintenance_after) - epoch_us(occurred_at)) // 60000000) as minutes_to_first_maintenance
  from r_failures left join m2a using (failure_id) left join m2b using (failure_id)
)"""

M3 = f"""
m3a as (
  select make_date(year(planned_date), month(planned_date), 1) as month_date, machine_id, market, steel_grade,
    count(*) as total_orders, {N('is_completed')} as completed_orders, {N('is_delayed')} as delayed_orders,
    {N('is_completed = false')} as incomplete_orders,
    {R(SD(N('is_completed'), 'count(*)'), 4)} as completion_rate,
    {R(SD(N('is_delayed'), N('is_completed')), 4)} as delay_rate,
    {R('sum(total_weight_tons)', 2)} as total_tons_produced, {R('avg(total_weight_tons)', 2)} as avg_order_weight_tons,
    {R('avg(duration_variance_minutes)', 1)} as avg_duration_variance_min,
    {R('avg(demand_index_at_intake)', 4)} as avg_demand_index, {R('avg(rush_factor_at_intake)', 4)} as avg_rush_factor
  from r_orders where machine_id is not null group by all
),
m3b as (
  select make_date(year(demand_date), month(demand_date), 1) as month_date,
    {R('sum(expected_total_tons)', 2)} as monthly_expected_tons,
    {R('avg(trend_index)', 4)} as avg_trend_index, {R('avg(seasonal_index)', 4)} as avg_seasonal_index
  from r_demand group by all
),
m3 as (
  select * exclude (forecast), forecast.monthly_expected_tons, forecast.avg_trend_index, forecast.avg_seasonal_index,
    {R(SD('total_tons_produced', 'forecast.monthly_expected_tons'), 4)} as production_vs_forecast_ratio
  from (select m3a.*, (select m3b from m3b where m3b.month_date = m3a.month_date) as forecast from m3a)
)"""


def q(ctes: list[str], body: str) -> str:
    return with_roles("with " + ",\n".join(c.strip() for c in ctes) + "\n" + body)


ORACLE: dict[str, str] = {
    "i1_enriched": q([I1], "select * from i1"),
    "m1_machine_health": q([I1, M1], "select * from m1"),
    "m2a_pre_failure_state": q([I1, M2], "select * from m2a"),
    "m2b_post_failure_maintenance": q([I1, M2], "select * from m2b"),
    "m2_failure_analysis": q([I1, M2], "select * from m2"),
    "m3a_monthly_orders": q([M3], "select * from m3a"),
    "m3b_monthly_demand": q([M3], "select * from m3b"),
    "m3_production_performance": q([M3], "select * from m3"),
}


# -- operator-level oracles -------------------------------------------------------

J5 = """
select f.failure_id, f.machine_id, f.occurred_at, t.recorded_at
from r_failures f
join r_telemetry t on t.machine_id = f.machine_id
  and t.recorded_at >= f.occurred_at - interval 24 hour
  and t.recorded_at < f.occurred_at
"""

ORACLE.update(
    {
        "j5_interval_join": with_roles(J5, ("r_telemetry", "r_failures")),
        "w1_rolling": q(
            [I1, M1],
            "select machine_id, recording_date, composite_health_score, rolling_7d_health from m1",
        ),
        "x1_ns_timestamp": """
            select event_id, epoch_us(ts) * 1000 + event_id % 1000 as ts_ns,
              make_timestamp((epoch_us(ts) * 1000 + event_id % 1000) // 1000) as ts_exact
            from events""",
        "x6_minutes": """
            select event_id, date_sub('minute', date_trunc('hour', ts) + interval 30 minute, ts) as minutes
            from events""",
        "x7_elapsed": """
            select event_id,
              cast(epoch_us(ts) // 1000000 - epoch_us(date_trunc('day', ts)) // 1000000 as double) / 60
                as elapsed_minutes
            from events""",
        "v4_is_delayed": with_roles(
            "select order_id, is_completed, duration_variance_minutes, is_delayed from r_orders",
            ("r_orders",),
        ),
    }
)


# -- data quality oracles ----------------------------------------------------------

_MODEL_CTE = {
    "stg_telemetry": "r_telemetry",
    "stg_failures": "r_failures",
    "stg_maintenance": "r_maintenance",
    "stg_orders": "r_orders",
    "stg_demand": "r_demand",
    "int_telemetry_enriched": "i1",
    "mart_machine_health": "m1",
    "mart_failure_analysis": "m2",
    "mart_production_performance": "m3",
}


# The declared data tests, as "model.column" per kind.
_NOT_NULL = """
stg_telemetry.recorded_at stg_telemetry.machine_id stg_telemetry.is_anomaly stg_telemetry.failure_predicted_24h
stg_failures.failure_id stg_failures.machine_id stg_failures.occurred_at
stg_maintenance.maintenance_id stg_maintenance.machine_id stg_maintenance.is_planned
stg_orders.order_id stg_orders.is_delayed
stg_demand.demand_date stg_demand.expected_total_tons
int_telemetry_enriched.recorded_at int_telemetry_enriched.machine_id int_telemetry_enriched.is_anomaly
mart_machine_health.recording_date mart_machine_health.machine_id mart_machine_health.composite_health_score
mart_machine_health.health_status
mart_failure_analysis.failure_id mart_failure_analysis.machine_id mart_failure_analysis.was_predicted
mart_production_performance.month_date mart_production_performance.machine_id
"""
_UNIQUE = """
stg_failures.failure_id stg_maintenance.maintenance_id stg_orders.order_id stg_demand.demand_date
mart_failure_analysis.failure_id
"""
_UNIT_RANGE = """
mart_machine_health.composite_health_score mart_machine_health.availability_rate
mart_production_performance.completion_rate mart_production_performance.delay_rate
"""
_SOURCE_NOT_NULL = """
telemetry.timestamp telemetry.machine_id telemetry.label_anomaly
failures.failure_id failures.machine_id failures.timestamp_occurrence
maintenance.maintenance_id maintenance.machine_id orders.order_id demand.date
"""
_SOURCE_UNIQUE = "failures.failure_id maintenance.maintenance_id orders.order_id demand.date"


def _violated(names: str, check: str, params: str, bad: str, source: dict[str, str]) -> list[str]:
    """One SELECT per tested column; ``bad`` counts its violations."""
    out = []
    for table, column in (x.split(".") for x in names.split()):
        n = bad.format(c=f'"{column}"')
        out.append(
            f"""select '{table}' as "table", '{column}' as "column", '{check}' as "check", '{params}' as params,
              {n} as violations, {n} = 0 as passed from {source[table]}"""
        )
    return out


_IS_NULL = "count(*) - count({c})"
_REPEATED = "len(list_filter(map_values(histogram({c})), lambda x: x > 1))"


def _quality_sql(parts: list[str]) -> str:
    return q([I1, M1, M2, M3], "\nunion all\n".join(parts))


def _freshness_sql() -> str:
    from millpulse.plans.registry import FRESHNESS_AS_OF

    params = f"as_of={FRESHNESS_AS_OF};error_after_days=400"
    stale = (
        f"case when coalesce(max(recorded_at) < timestamp '{FRESHNESS_AS_OF}' - interval 400 day, true) "
        "then 1 else 0 end"
    )
    return with_roles(
        f"""select 'stg_telemetry' as "table", 'recorded_at' as "column", 'freshness' as "check",
          '{params}' as params, cast({stale} as bigint) as violations, {stale} = 0 as passed
        from r_telemetry""",
        ("r_telemetry",),
    )


def _row_count_sql() -> str:
    from millpulse.operators.quality import EXPECTED_ROWS

    parts = []
    for name in ("telemetry", "failures", "maintenance", "orders", "demand"):
        n = EXPECTED_ROWS[name]
        parts.append(
            f"""select 'stg_{name}' as "table", '*' as "column", 'row_count' as "check",
              'expected={n}' as params, abs(count(*) - {n}) as violations,
              abs(count(*) - {n}) = 0 as passed from r_{name}"""
        )
    return with_roles("\nunion all\n".join(parts))


ORACLE.update(
    {
        "d1_not_null": _quality_sql(_violated(_NOT_NULL, "not_null", "", _IS_NULL, _MODEL_CTE)),
        "d2_unique": _quality_sql(_violated(_UNIQUE, "unique", "", f"cast({_REPEATED} as bigint)", _MODEL_CTE)),
        "d3_accepted_values": _quality_sql(
            _violated(
                "mart_machine_health.health_status", "accepted_values", "values=healthy|warning|critical",
                "count({c}) - count(*) filter (where {c} = 'healthy' or {c} = 'warning' or {c} = 'critical')", _MODEL_CTE,
            )
        ),
        "d4_accepted_range": _quality_sql(
            _violated(_UNIT_RANGE, "accepted_range", "max_value=1;min_value=0", "count(*) filter (where {c} < 0 or {c} > 1)", _MODEL_CTE)
        ),
        "d5_freshness": _freshness_sql(),
        "d6_row_count": _row_count_sql(),
    }
)


# -- dashboard oracles ---------------------------------------------------------------


def _corr(src: str, x: str, y: str) -> str:
    both = f"{x} is not null and {y} is not null"
    xx = f"cast(case when {both} then {x} end as double)"
    yy = f"cast(case when {both} then {y} end as double)"
    pearson = f"covar_samp({xx}, {yy}) / nullif(stddev_samp({xx}) * stddev_samp({yy}), 0)"
    return (
        f"select '{x}' as pressure, '{y}' as outcome, "
        f"{R(pearson, 4)} as correlation, "
        f"count(*) filter (where {x} is not null and {y} is not null) as pairs from {src}"
    )


ORACLE.update(
    {
        "q1_kpi_scorecards": q(
            [I1, M1, M2, M3],
            f"""select 'avg_composite_health' as kpi, {R('avg(composite_health_score)', 4)} as value from m1
            union all select 'total_failures', cast(count(*) as double) from m2
            union all select 'avg_completion_rate', {R('avg(completion_rate)', 4)} from m3""",
        ),
        "q2_health_trend": q(
            [I1, M1],
            f"""select recording_date, {R('avg(composite_health_score)', 4)} as avg_composite_health,
              count(*) as machines from m1 group by recording_date""",
        ),
        "q3_tons_vs_forecast": q(
            [M3],
            f"""select month_date, {R('sum(total_tons_produced)', 2)} as tons_produced,
              max(monthly_expected_tons) as expected_tons from m3 group by month_date""",
        ),
        "q4_rolling_health": q(
            [I1, M1],
            "select machine_id, recording_date, composite_health_score, rolling_7d_health, health_status from m1",
        ),
        "q5_status_distribution": q(
            [I1, M1], "select machine_id, health_status, count(*) as days from m1 group by 1, 2"
        ),
        "q6_failure_frequency": q(
            [I1, M2],
            """select failure_category, root_cause, count(*) as failures,
              count(*) filter (where was_predicted) as predicted_failures from m2 group by 1, 2""",
        ),
        "q7_pressure_correlation": q(
            [I1, M1, M3],
            "\nunion all\n".join(
                [
                    _corr("m3", "avg_demand_index", "delay_rate"),
                    _corr("m3", "avg_rush_factor", "delay_rate"),
                    _corr("m1", "avg_demand_index", "readings_predicting_failure_24h"),
                    _corr("m1", "avg_rush_factor", "readings_predicting_failure_24h"),
                ]
            ),
        ),
        "q8_delay_hotspots": q(
            [M3],
            f"""select steel_grade, market, cast(sum(delayed_orders) as bigint) as delayed_orders,
              cast(sum(completed_orders) as bigint) as completed_orders,
              {R(SD('sum(delayed_orders)', 'sum(completed_orders)'), 4)} as delay_rate
            from m3 group by 1, 2""",
        ),
        "q9_sliced_failures": q(
            [I1, M2],
            """select * from m2 where occurrence_date >= date '1999-01-08'
              and occurrence_date <= date '1999-01-21' and failure_category in ('bearing', 'lube')""",
        ),
        "q9_sliced_health": q(
            [I1, M1],
            """select * from m1 where recording_date between date '1999-01-08' and date '1999-01-21'
              and health_status <> 'healthy'""",
        ),
        "q9_sliced_production": q(
            [M3],
            """select * from m3 where month_date between date '1995-01-01' and date '1996-12-31'
              and market = '1-URGENT'""",
        ),
        "q10_mart_row_counts": q(
            [I1, M1, M2, M3],
            """select 'health' as mart, count(*) as row_count from m1
            union all select 'failures', count(*) from m2
            union all select 'production', count(*) from m3""",
        ),
        "q11_machines_needing_action": q(
            [I1, M1],
            """select machine_id, recording_date as latest_date, composite_health_score,
              rolling_7d_health, health_status
            from (select *, row_number() over (partition by machine_id order by recording_date desc) as rn
                  from m1) where rn = 1""",
        ),
    }
)


# -- raw path oracles ------------------------------------------------------------------

from millpulse.sources import raw_roles_sql as _raw  # noqa: E402

ORACLE["d_source_tests"] = (
    "with "
    + ", ".join(f"raw_{n} as ({_raw.clean_sql(n)})" for n in ("telemetry", "failures", "maintenance", "orders", "demand"))
    + " "
    + "\nunion all\n".join(
        _violated(names, check, "", bad, {n: f"raw_{n}" for n in ("telemetry", "failures", "maintenance", "orders", "demand")})[i]
        for names, check, bad in ((_SOURCE_NOT_NULL, "not_null", _IS_NULL), (_SOURCE_UNIQUE, "unique", f"cast({_REPEATED} as bigint)"))
        for i in range(len(names.split()))
    )
)
ORACLE["d5_source_freshness"] = """
    select 'telemetry' as "table", 'loaded_at' as "column", 'freshness' as "check",
      'as_of=2000-01-01 00:00:00;error_after_days=400' as params,
      cast(if(count(*) = 0 or timestamp '1998-11-01 00:00:00' < timestamp '2000-01-01 00:00:00' - interval 400 day, 1, 0) as bigint) as violations,
      not (count(*) = 0 or timestamp '1998-11-01 00:00:00' < timestamp '2000-01-01 00:00:00' - interval 400 day) as passed
    from events
"""

for _i, _name in enumerate(["telemetry", "failures", "maintenance", "orders", "demand"], start=1):
    ORACLE[f"t{_i}_clean_{_name}"] = _raw.clean_sql(_name)
    ORACLE[f"v{_i}_stg_{_name}"] = _raw.stage_sql(_name)


# -- write-side oracles: what a reader sees after loads, replaces and refreshes -------------

_SOURCES = ("telemetry", "failures", "maintenance", "orders", "demand")
_RAW_YEAR = {
    "telemetry": "year(make_timestamp(\"timestamp\" // 1000))", "failures": "year(make_timestamp(timestamp_occurrence // 1000))",
    "maintenance": "year(make_timestamp(timestamp_start // 1000))", "orders": "year(make_timestamp(timestamp_planned // 1000))",
    "demand": "year(\"date\")",
}
_CLEAN_DAY = {"telemetry": '"date"', "failures": '"date"', "maintenance": '"date"', "orders": "date_planned", "demand": '"date"'}


def _load_year(day_or_year: str) -> str:
    return f"if({day_or_year} > 1995, 1996, 1995)"


def _load_counts() -> str:
    parts = []
    for n in _SOURCES:
        day, year = _CLEAN_DAY[n], _load_year(f"year({_CLEAN_DAY[n]})")
        parts.append(
            f"""select '{n}' as source, load_year, 'created' as written,
              (select count(*) from ({_raw.raw_sql(n)}) where {_load_year(_RAW_YEAR[n])} = load_year) as raw_rows,
              count(mine) as clean_rows, count(mine) as stored_rows, min(d) as first_day, max(d) as last_day
            from (values (1995), (1996)) as y(load_year) left join (select {year} as mine, {day} as d from ({_raw.clean_sql(n)})) on mine = load_year
            group by load_year"""
        )
    return "\nunion all\n".join(parts)


def _on_raw(ctes: list[str], body: str, replaced: dict[str, str] | None = None) -> str:
    """A model query over the staged raw roles, some of them replaced."""
    staged = {n: f"select * from ({_raw.stage_sql(n)})" for n in _SOURCES} | (replaced or {})
    return "with " + ",\n".join([*(f"r_{n} as ({sql})" for n, sql in staged.items()), *(c.strip() for c in ctes)]) + "\n" + body


_CANCELLED = "if({year} > 1995, total_weight_tons, total_weight_tons * 2)"
_KEPT = "({year} > 1995 or market <> '1-URGENT' or market is null)"
_HALVED = "if({day} = date '1999-01-10', bearing_health / 2, bearing_health)"

ORACLE.update(
    {
        "d1_footers": "with "
        + ", ".join(f"raw_{n} as ({_raw.clean_sql(n)})" for n in _SOURCES)
        + " "
        + "\nunion all\n".join(_violated(_SOURCE_NOT_NULL, "not_null", "", _IS_NULL, {n: f"raw_{n}" for n in _SOURCES})),
        "d6_stored_rows": "\nunion all\n".join(
            f"""select '{n}' as "table", count(*) as row_count from ({_raw.clean_sql(n)})"""
            + (""" where "date" not between date '1999-01-08' and date '1999-01-14' or status <> 'purchase'""" if n == "telemetry" else "")
            for n in _SOURCES
        ),
        "t6_load_year": _load_counts(),
        "k1_day_replace": f"""
            select "date", machine_id, status, if("date" between date '1999-01-08' and date '1999-01-14', {_HALVED.format(day='"date"')}, bearing_health) as bearing_health, "timestamp"
            from ({_raw.clean_sql("telemetry")})
            where "date" not between date '1999-01-08' and date '1999-01-14' or status <> 'purchase'""",
        "k3_year_replace": f"""
            select {_load_year("year(date_planned)")} as load_year, order_id, market, date_planned,
              {_CANCELLED.format(year="coalesce(year(date_planned), 0)")} as total_weight_tons, is_completed
            from ({_raw.clean_sql("orders")}) where {_KEPT.format(year="coalesce(year(date_planned), 0)")}""",
        "k5_view": f"""
            select order_id, market, planned_date, {_CANCELLED.format(year="coalesce(year(planned_date), 0)")} as total_weight_tons, is_delayed
            from ({_raw.stage_sql("orders")}) where {_KEPT.format(year="coalesce(year(planned_date), 0)")} and market is not null""",
        "k6_publish": _on_raw([M3], "select * from m3"),
        "k7_refresh": _on_raw(
            [I1, M1], "select * from m1",
            {"telemetry": f"select * replace ({_HALVED.format(day='recording_date')} as bearing_health) from ({_raw.stage_sql('telemetry')}) where status <> 'purchase'"},
        ),
    }
)
