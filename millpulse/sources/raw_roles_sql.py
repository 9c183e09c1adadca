"""DuckDB SQL of ``millpulse.sources.raw_roles`` plus cleaning (T1-T5) and
staging (V1-V5) written as SQL, for the oracle of the raw-path queries."""

from __future__ import annotations

from millpulse.sources.schemas import schema

_REC = "(ts - interval 25 year)"
_NS = f"(epoch_us({_REC}) * 1000 + event_id % 1000)"
_CATEGORY = "case event_id % 3 when 0 then 'bearing' when 1 then 'lube' else 'motor' end"
_WEEKEND = f"case when dayofweek(cast({_REC} as date)) in (0, 6) then 1 else 0 end"  # 0 = Sunday

TELEMETRY = f"""
select {_NS} as "timestamp",
  case when event_id % 97 = 0 then null else concat('Mill_', cast(user_id as varchar)) end as machine_id,
  event_id % 3 as shift_id,
  cast(event_id % 37 as double) / 37 as demand_index, cast(event_id % 13 as double) / 13 as rush_factor,
  cast(event_id % 11 as double) / 11 as maintenance_deferral,
  {_WEEKEND} as is_weekend,
  cast(event_id % 17 as double) / 17 as month_pulse_index, cast(event_id % 19 as double) / 19 as trend_index,
  event_type as status,
  case when event_type = 'view' then null else cast(event_id as varchar) end as active_order_id,
  concat('G', cast(event_id % 4 as varchar)) as steel_grade_active,
  value / 50 as hardness_index_active,
  cast(event_id % 50 as double) / 50 as load_index,
  value / 2 + 40 as bearing_temp_c, value / 100 as vibration_rms, value * 10 as motor_torque_nm,
  1 - least(value, 500) / 500 as bearing_health, 1 - least(value, 250) / 250 as lube_health,
  1 - cast(event_id % 100 as double) / 200 as align_health,
  case when event_type = 'error' then cast(0.25 as double) else cast(0.75 as double) end as motor_health,
  cast(event_id as double) / 6 as cumulative_op_hours, cast(event_id % 500 as double) / 6 as op_hours_since_lube,
  cast(event_id % 700 as double) / 6 as op_hours_since_calib, cast(event_id % 900 as double) / 6 as op_hours_since_bearing,
  cast(event_id % 1100 as double) / 6 as op_hours_since_major,
  case when event_type = 'click' then cast(event_id * 2 as varchar) end as active_maintenance_id,
  case when event_type = 'click' then concat('type_', cast(event_id % 4 as varchar)) end as active_maintenance_type,
  cast(event_id - event_id % 7 as varchar) as last_failure_id,
  case when value > 200 then 2 when value > 120 then 1 when event_id % 89 = 0 then null else 0 end as label_anomaly,
  case when value > 60 then 1 else 0 end as label_failure_in_24h,
  case when value > 30 then 1 else 0 end as label_failure_in_72h,
  case when value > 30 then {_CATEGORY} end as label_failure_type_next,
  case when event_type = 'error' then 0 else 1 end as is_running,
  value / 300 as vib_norm, value / 400 as temp_norm, (value - 50) / 25 as vib_z, (value - 40) / 20 as temp_z
from events
"""

FAILURES = f"""
select case when event_id % 101 = 0 then null else cast(event_id as varchar) end as failure_id,
  concat('Mill_', cast(user_id as varchar)) as machine_id,
  {_NS} as timestamp_occurrence,
  {_CATEGORY} as failure_category,
  case event_id % 4 when 0 then 'wear' when 1 then 'overload' else 'misalignment' end as root_cause,
  event_id % 5 + 1 as severity_level,
  concat('G', cast(event_id % 4 as varchar)) as steel_grade_active,
  value / 50 as hardness_index_active,
  value / 100 as load_index_at_failure, value / 2 + 40 as bearing_temp_c_at_failure,
  value / 100 as vibration_rms_at_failure, value * 10 as motor_torque_nm_at_failure,
  1 - least(value, 500) / 500 as bearing_health_at_failure, 1 - least(value, 250) / 250 as lube_health_at_failure,
  1 - cast(event_id % 100 as double) / 200 as align_health_at_failure,
  cast(0.25 as double) as motor_health_at_failure,
  cast(event_id % 37 as double) / 37 as demand_index, cast(event_id % 13 as double) / 13 as rush_factor,
  cast(event_id % 11 as double) / 11 as maintenance_deferral,
  {_WEEKEND} as is_weekend,
  cast(event_id % 17 as double) / 17 as month_pulse_index, cast(event_id % 19 as double) / 19 as trend_index
from events where event_type = 'error'
"""

_ORDER_NS = "(epoch_us(o_orderdate) * 1000)"
_START_NS = f"({_ORDER_NS} + (o_custkey % 48) * 3600000000000 + o_orderkey % 997)"

MAINTENANCE = f"""
select cast(o_orderkey as varchar) as maintenance_id,
  case when o_orderkey % 53 = 0 then null else concat('Mill_', cast(o_custkey % 5 as varchar)) end as machine_id,
  {_START_NS} as timestamp_start,
  o_orderpriority as maint_type, o_orderpriority = '5-LOW' as is_planned,
  case when o_orderstatus = 'P' then null else cast(o_custkey as varchar) end as linked_failure_id,
  cast(floor(o_totalprice / 1000) as bigint) as duration_minutes
from orders
"""

ORDERS = f"""
select cast(o_orderkey as varchar) as order_id,
  case when o_orderkey % 13 = 0 then null else {_ORDER_NS} end as timestamp_planned,
  case when o_orderstatus = 'O' then null else {_START_NS} end as timestamp_start,
  case when o_orderstatus = 'F'
    then {_START_NS} + (o_orderkey % 500) * 60000000000 + o_custkey % 59 * 1000000000 end as timestamp_end,
  o_orderpriority as market, concat('G', cast(o_orderkey % 4 as varchar)) as steel_grade,
  o_totalprice / 100000 as hardness_index, o_totalprice / 10000 as total_weight_tons,
  cast(o_orderkey % 37 as double) / 37 as demand_index_at_intake,
  cast(o_orderkey % 13 as double) / 13 as rush_factor_at_intake,
  cast(o_orderkey % 17 as double) / 17 as month_pulse_index_at_intake,
  cast(o_orderkey % 19 as double) / 19 as trend_index_at_intake,
  case when dayofweek(o_orderdate) in (0, 6) then 1 else 0 end as is_weekend_intake,
  case when o_orderkey % 10 = 0 then null else concat('Mill_', cast(o_custkey % 5 as varchar)) end as machine_id_started,
  cast(o_custkey % 400 as double) as duration_minutes_planned,
  o_orderstatus as status,
  case when o_orderstatus = 'P' then null else o_orderstatus = 'F' end as is_completed
from orders
"""

DEMAND = """
select "date", isodow("date") - 1 as weekday,
  case when isodow("date") - 1 >= 5 then 1 else 0 end as is_weekend,
  cast(n as double) / 24 as trend_index, cast(min_line as double) / 7 as seasonal_index,
  cast(max_line as double) / 7 as month_pulse_index, qty as expected_total_tons,
  cast(min_line as double) / 10 as market_split_domestic, 1 - cast(min_line as double) / 10 as market_split_export,
  qty * (cast(min_line as double) / 10) as expected_domestic_tons,
  qty * (1 - cast(min_line as double) / 10) as expected_export_tons
from (select cast(l_shipdate as date) as "date", sum(l_quantity) as qty, count(*) as n,
        min(l_linenumber) as min_line, max(l_linenumber) as max_line
      from lineitem group by 1)
"""

_BODY = {"telemetry": TELEMETRY, "failures": FAILURES, "maintenance": MAINTENANCE, "orders": ORDERS, "demand": DEMAND}
_DUCK_TYPE = {"string": "varchar", "bigint": "bigint", "double": "double", "boolean": "boolean", "date": "date"}


def _declared(name: str) -> str:
    cols = ", ".join(
        f'cast("{f.name}" as {_DUCK_TYPE[f.dataType.simpleString()]}) as "{f.name}"'
        for f in schema(name).fields
    )
    return f"select {cols} from ({_BODY[name].strip()})"


def _ts(col: str) -> str:
    return f'make_timestamp("{col}" // 1000)'


CLEAN = {
    "telemetry": f"""
select * replace ({_ts('timestamp')} as "timestamp", cast(is_running as boolean) as is_running,
                  cast(is_weekend as boolean) as is_weekend),
  cast({_ts('timestamp')} as date) as "date",
  cast(label_anomaly as boolean) as is_anomaly,
  cast(label_failure_in_24h as boolean) as fail_in_24h,
  cast(label_failure_in_72h as boolean) as fail_in_72h
from raw_telemetry where "timestamp" is not null and machine_id is not null""",
    "failures": f"""
select * replace ({_ts('timestamp_occurrence')} as timestamp_occurrence, cast(is_weekend as boolean) as is_weekend),
  cast({_ts('timestamp_occurrence')} as date) as "date",
  cast(year(cast({_ts('timestamp_occurrence')} as date)) as bigint) as "year"
from raw_failures where failure_id is not null and machine_id is not null and timestamp_occurrence is not null""",
    "maintenance": f"""
select * replace ({_ts('timestamp_start')} as timestamp_start),
  cast({_ts('timestamp_start')} as date) as "date",
  cast(year(cast({_ts('timestamp_start')} as date)) as bigint) as "year"
from raw_maintenance where maintenance_id is not null and machine_id is not null and timestamp_start is not null""",
    "orders": f"""
select *, case when actual_duration_minutes is not null
              then actual_duration_minutes - duration_minutes_planned end as duration_variance_minutes
from (
  select *, cast(timestamp_planned as date) as date_planned, cast(timestamp_start as date) as date_start,
    cast(year(cast(timestamp_planned as date)) as bigint) as "year",
    case when timestamp_end is not null and timestamp_start is not null
      then cast(epoch_us(timestamp_end) // 1000000 - epoch_us(timestamp_start) // 1000000 as double) / 60
    end as actual_duration_minutes
  from (
    select * replace ({_ts('timestamp_planned')} as timestamp_planned, {_ts('timestamp_start')} as timestamp_start,
                      {_ts('timestamp_end')} as timestamp_end,
                      cast(is_weekend_intake as boolean) as is_weekend_intake)
    from raw_orders where order_id is not null))""",
    "demand": """
select * replace (cast(is_weekend as boolean) as is_weekend), cast(year("date") as bigint) as "year"
from raw_demand where "date" is not null""",
}

STAGE = {
    "telemetry": """
select "timestamp" as recorded_at, cast("timestamp" as date) as recording_date, machine_id, shift_id, status,
  cast(is_running as boolean) as is_running, cast(is_weekend as boolean) as is_weekend,
  active_order_id, steel_grade_active, hardness_index_active, active_maintenance_id, active_maintenance_type,
  last_failure_id, demand_index, rush_factor, maintenance_deferral, month_pulse_index, trend_index, load_index,
  bearing_temp_c, vibration_rms, motor_torque_nm, bearing_health, lube_health, align_health, motor_health,
  cumulative_op_hours, op_hours_since_lube, op_hours_since_calib, op_hours_since_bearing, op_hours_since_major,
  cast(label_anomaly as boolean) as is_anomaly,
  cast(label_failure_in_24h as boolean) as failure_predicted_24h,
  cast(label_failure_in_72h as boolean) as failure_predicted_72h,
  label_failure_type_next as predicted_failure_type,
  vib_norm, temp_norm, vib_z, temp_z
from t_telemetry where "timestamp" is not null and machine_id is not null""",
    "failures": """
select failure_id, machine_id, timestamp_occurrence as occurred_at, cast(timestamp_occurrence as date) as occurrence_date,
  failure_category, root_cause, severity_level, steel_grade_active, hardness_index_active,
  load_index_at_failure, bearing_temp_c_at_failure, vibration_rms_at_failure, motor_torque_nm_at_failure,
  bearing_health_at_failure, lube_health_at_failure, align_health_at_failure, motor_health_at_failure,
  demand_index, rush_factor, maintenance_deferral, cast(is_weekend as boolean) as is_weekend,
  month_pulse_index, trend_index
from t_failures where failure_id is not null and machine_id is not null and timestamp_occurrence is not null""",
    "maintenance": """
select maintenance_id, machine_id, timestamp_start as started_at, cast(timestamp_start as date) as maintenance_date,
  maint_type, is_planned, linked_failure_id, duration_minutes
from t_maintenance where maintenance_id is not null and machine_id is not null and timestamp_start is not null""",
    "orders": """
select order_id, machine_id_started as machine_id, market, steel_grade, hardness_index, total_weight_tons,
  status, is_completed, timestamp_planned as planned_at, timestamp_start as started_at, timestamp_end as ended_at,
  cast(timestamp_planned as date) as planned_date, cast(timestamp_start as date) as start_date,
  duration_minutes_planned, actual_duration_minutes, duration_variance_minutes,
  coalesce(duration_variance_minutes > 0, false) as is_delayed,
  demand_index_at_intake, rush_factor_at_intake, month_pulse_index_at_intake, trend_index_at_intake,
  cast(is_weekend_intake as boolean) as is_weekend_intake
from t_orders where order_id is not null""",
    "demand": """
select "date" as demand_date, weekday, cast(is_weekend as boolean) as is_weekend, trend_index, seasonal_index,
  month_pulse_index, expected_total_tons, market_split_domestic, market_split_export,
  expected_domestic_tons, expected_export_tons
from t_demand where "date" is not null""",
}


def raw_sql(name: str) -> str:
    return f"with raw_{name} as ({_declared(name)})\nselect * from raw_{name}"


def clean_sql(name: str) -> str:
    return f"with raw_{name} as ({_declared(name)}),\nt_{name} as ({CLEAN[name].strip()})\nselect * from t_{name}"


def stage_sql(name: str) -> str:
    return (
        f"with raw_{name} as ({_declared(name)}),\nt_{name} as ({CLEAN[name].strip()}),\n"
        f"v_{name} as ({STAGE[name].strip()})\nselect * from v_{name}"
    )
