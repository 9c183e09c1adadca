"""Join each anchor event to the points of the same key that precede it
within a look-back window: ``anchor_ts - lookback <= point_ts < anchor_ts``.

Spark has no interval join.  As "equi-join on the key, range as a post-filter"
every anchor is compared with its key's whole history, and with few keys
(machines) the work lands on few tasks.  ``window_join`` adds the calendar day
to the equi-join key: each anchor is exploded to the days its window touches
(two for 24 h), each point sits in exactly one day, so no pair is produced twice
and the exact time predicates stay as the post-filter.  A hot key (a machine
with a third of all readings) is split over its days.  Catalyst broadcasts the
anchors where their measured size allows it, which also prunes the points' day
partitions; elsewhere both sides are shuffled on (key, day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DAY = "__window_day"


def window_join(
    anchors: DataFrame,
    points: DataFrame,
    on: list[str],
    anchor_ts: str,
    point_ts: str,
    point_day: str,
    lookback_hours: int = 24,
) -> DataFrame:
    """Day-bucketed interval join.

    ``point_day`` must be ``to_date(point_ts)`` (e.g. the partition column
    ``recording_date``), which also lets the scan prune day partitions.
    """
    lookback = F.expr(f"INTERVAL {int(lookback_hours)} HOURS")
    days = F.sequence(F.to_date(F.col(anchor_ts) - lookback), F.to_date(F.col(anchor_ts)))
    a = anchors.withColumn(_DAY, F.explode(days))
    names = {k: f"__p_{k}" for k in on}
    p = points.withColumnsRenamed(names)
    cond = [F.col(k) == F.col(names[k]) for k in on]
    cond += [
        F.col(point_day) == F.col(_DAY),
        F.col(point_ts) >= F.col(anchor_ts) - lookback,
        F.col(point_ts) < F.col(anchor_ts),
    ]
    return p.join(a, cond, "inner").drop(*names.values(), _DAY)
