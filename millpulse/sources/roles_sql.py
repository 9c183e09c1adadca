"""DuckDB SQL of the role views in ``millpulse.sources.roles`` (oracle input).

Each entry is the body of a CTE over the driver's pre-registered tables; the
Spark side builds the same rows with DataFrame expressions.
"""

from __future__ import annotations

TELEMETRY = """
select ts - interval 25 year as recorded_at,
  cast(ts - interval 25 year as date) as recording_date,
  concat('Mill_', cast(user_id as varchar)) as machine_id,
  event_id % 3 as shift_id, event_type as status,
  event_type <> 'error' as is_running,
  dayofweek(cast(ts - interval 25 year as date)) in (0, 6) as is_weekend,
  case when event_type = 'view' then null else event_id end as active_order_id,
  concat('G', cast(event_id % 4 as varchar)) as steel_grade_active,
  case when event_type = 'click' then event_id * 2 end as active_maintenance_id,
  case when event_type = 'click' then concat('type_', cast(event_id % 4 as varchar)) end as active_maintenance_type,
  event_id - event_id % 7 as last_failure_id,
  cast(event_id % 37 as double) / 37 as demand_index, cast(event_id % 13 as double) / 13 as rush_factor,
  cast(event_id % 11 as double) / 11 as maintenance_deferral,
  cast(event_id % 50 as double) / 50 as load_index,
  value / 2 + 40 as bearing_temp_c, value / 100 as vibration_rms, value * 10 as motor_torque_nm,
  1 - least(value, 500) / 500 as bearing_health, 1 - least(value, 250) / 250 as lube_health,
  1 - cast(event_id % 100 as double) / 200 as align_health,
  case when event_type = 'error' then cast(0.25 as double) else cast(0.75 as double) end as motor_health,
  cast(event_id as double) / 6 as cumulative_op_hours, cast(event_id % 500 as double) / 6 as op_hours_since_lube,
  cast(event_id % 700 as double) / 6 as op_hours_since_calib, cast(event_id % 900 as double) / 6 as op_hours_since_bearing,
  cast(event_id % 1100 as double) / 6 as op_hours_since_major,
  value > 120 as is_anomaly, value > 60 as failure_predicted_24h, value > 30 as failure_predicted_72h,
  case when value > 30 then case event_id % 3 when 0 then 'bearing' when 1 then 'lube' else 'motor' end end
    as predicted_failure_type
from events
"""

FAILURES = """
select event_id as failure_id, concat('Mill_', cast(user_id as varchar)) as machine_id,
  ts - interval 25 year as occurred_at, cast(ts - interval 25 year as date) as occurrence_date,
  case event_id % 3 when 0 then 'bearing' when 1 then 'lube' else 'motor' end as failure_category,
  case event_id % 4 when 0 then 'wear' when 1 then 'overload' else 'misalignment' end as root_cause,
  event_id % 5 + 1 as severity_level,
  concat('G', cast(event_id % 4 as varchar)) as steel_grade_active,
  dayofweek(cast(ts - interval 25 year as date)) in (0, 6) as is_weekend,
  value / 100 as load_index_at_failure,
  value / 2 + 40 as bearing_temp_c_at_failure, value / 100 as vibration_rms_at_failure,
  value * 10 as motor_torque_nm_at_failure,
  1 - least(value, 500) / 500 as bearing_health_at_failure, 1 - least(value, 250) / 250 as lube_health_at_failure,
  1 - cast(event_id % 100 as double) / 200 as align_health_at_failure,
  cast(0.25 as double) as motor_health_at_failure,
  cast(event_id % 37 as double) / 37 as demand_index, cast(event_id % 13 as double) / 13 as rush_factor,
  cast(event_id % 11 as double) / 11 as maintenance_deferral
from events where event_type = 'error'
"""

MAINTENANCE = """
select o_orderkey as maintenance_id, concat('Mill_', cast(o_custkey % 5 as varchar)) as machine_id,
  o_orderdate as started_at, cast(o_orderdate as date) as maintenance_date,
  o_orderpriority as maint_type, o_orderpriority = '5-LOW' as is_planned,
  case when o_orderstatus = 'P' then null else o_custkey end as linked_failure_id,
  cast(floor(o_totalprice / 1000) as bigint) as duration_minutes
from orders
"""

ORDERS = """
select o_orderkey as order_id,
  case when o_orderkey % 10 = 0 then null else concat('Mill_', cast(o_custkey % 5 as varchar)) end as machine_id,
  o_orderpriority as market, concat('G', cast(o_orderkey % 4 as varchar)) as steel_grade,
  o_totalprice / 10000 as total_weight_tons, o_orderstatus = 'F' as is_completed,
  o_orderdate as planned_at, cast(o_orderdate as date) as planned_date,
  case when o_orderstatus = 'F' then cast(o_custkey % 300 - o_orderkey % 300 as double) end as duration_variance_minutes,
  coalesce(case when o_orderstatus = 'F' then o_custkey % 300 - o_orderkey % 300 end > 0, false) as is_delayed,
  cast(o_orderkey % 37 as double) / 37 as demand_index_at_intake, cast(o_orderkey % 13 as double) / 13 as rush_factor_at_intake
from orders
"""

DEMAND = """
select cast(l_shipdate as date) as demand_date, sum(l_quantity) as expected_total_tons,
  cast(count(*) as double) / 24 as trend_index, cast(min(l_linenumber) as double) / 7 as seasonal_index
from lineitem group by 1
"""

ROLE_SQL = {
    "r_telemetry": TELEMETRY,
    "r_failures": FAILURES,
    "r_maintenance": MAINTENANCE,
    "r_orders": ORDERS,
    "r_demand": DEMAND,
}


def with_roles(body: str, roles: tuple[str, ...] = tuple(ROLE_SQL)) -> str:
    """Prefix ``body`` with the role views it needs as CTEs."""
    ctes = ",\n".join(f"{name} as ({ROLE_SQL[name].strip()})" for name in roles)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
