"""Scalar column helpers shared by cleaning, staging and the marts.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed values that must equal the plant's definitions.
HEALTHY_AT = 0.80  # composite score at or above -> 'healthy'
WARNING_AT = 0.60  # composite score at or above -> 'warning', below -> 'critical'
HEALTH_STATUSES = ["healthy", "warning", "critical"]

# Rounding goes through a fixed-point decimal so that ties round half away
# from zero on the decimal value, independent of the binary expansion and of
# summation order.  Scale 10 absorbs floating noise far below the output scale.
_ROUND_VIA = DecimalType(38, 10)
# Outside this magnitude (and for NaN / infinity) the decimal cast would
# overflow; such values are rounded as doubles instead of failing the job.
_DECIMAL_SAFE = 1e27


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_up(col, scale: int) -> Column:
    """``round(x, scale)`` with decimal half-away-from-zero ties; returns double.

    NaN, infinities and magnitudes of 1e27 or more take plain double ``round``.
    """
    x = _c(col)
    exact = F.round(x.cast(_ROUND_VIA), scale).cast("double")
    return F.when(F.abs(x) < F.lit(_DECIMAL_SAFE), exact).otherwise(F.round(x, scale))


def safe_divide(numerator, denominator) -> Column:
    """Double division that yields NULL (not an error) on a zero or NULL divisor."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def ns_to_timestamp(name: str) -> Column:
    """Epoch nanoseconds (INT64) to TIMESTAMP, exact to the microsecond.

    Integral division keeps all 64 bits; a double division would round the
    nanosecond value to a multiple of 256 first and be 1 us off on some rows.
    Sub-microsecond digits are truncated toward zero.
    """
    return F.expr(f"timestamp_micros(`{name}` div 1000)")


def timestamp_to_ns(col) -> Column:
    """TIMESTAMP to epoch nanoseconds (microsecond resolution, INT64)."""
    return F.unix_micros(_c(col).cast("timestamp")) * F.lit(1000)


def flag(col) -> Column:
    """0/1 integer flag to BOOLEAN; any non-zero is true, NULL stays NULL."""
    return _c(col).cast("boolean")


def month_start(col) -> Column:
    """First day of the month as a DATE (``date_trunc(d, month)``)."""
    return F.trunc(_c(col), "month")


def minutes_between(later, earlier) -> Column:
    """Whole minutes from ``earlier`` to ``later``, truncated toward zero (BIGINT)."""
    return F.timestamp_diff("MINUTE", _c(earlier), _c(later))


def elapsed_minutes(end, start) -> Column:
    """Elapsed minutes as DOUBLE from whole-second epochs; NULL if either end is NULL."""
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / F.lit(60)


def health_status(score) -> Column:
    """Status bucket of a composite health score; a NULL score is 'critical'."""
    s = _c(score)
    return (
        F.when(s >= F.lit(HEALTHY_AT), F.lit("healthy"))
        .when(s >= F.lit(WARNING_AT), F.lit("warning"))
        .otherwise(F.lit("critical"))
    )
