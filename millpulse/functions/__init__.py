"""Column-expression helpers (all JVM-side, codegen friendly)."""

from millpulse.functions.scalar import (  # noqa: F401
    elapsed_minutes,
    flag,
    health_status,
    minutes_between,
    month_start,
    ns_to_timestamp,
    round_half_up,
    safe_divide,
    timestamp_to_ns,
)
