"""K8: cluster rows by several columns at once, along a Z-order curve.

Sorted by (a, b), every file holds nearly all values of b.  Here each column's values
are ranked by at most ``2 ** bits`` bounds of about equal row counts, and the ranks' bits are
interleaved: rows near each other on the curve are near in every column.  Range
partitioning by the curve gives files whose ranges overlap little in any column, so
a filter on the second column skips files as one on the first does.

Bounds come from a sample that Spark's range partitioner draws; they decide where
rows are stored, never what is stored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6

Bounds = Mapping[str, list]


def curve_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """For each column the least values of its range partitions: ``2 ** bits`` values at most."""
    out = {}
    for c in columns:
        ranged = df.select(F.col(c).alias("v")).where("v is not null").repartitionByRange(1 << bits, "v")
        least = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min("v").alias("v"))
        out[c] = sorted(r["v"] for r in least.collect())
    return out


def curve_key(bounds: Bounds, bits: int = BITS) -> Column:
    """The place on the curve: bits of the columns' ranks, highest first; null ranks below all values."""
    key = F.lit(0).cast("long")
    ranks = {}
    for c, values in bounds.items():
        rank = F.lit(0)
        for v in values:
            rank = rank + F.when(F.col(c) >= F.lit(v), 1).otherwise(0)
        # ranks spread over all bits: a column with few values turns the curve as early as one with many
        ranks[c] = F.floor(rank * ((1 << bits) - 1) / max(len(values), 1)).cast("long")
    columns = list(ranks)
    for k in range(bits):
        for i, c in enumerate(columns):
            bit = F.shiftright(ranks[c], k).bitwiseAND(1)
            key = key + F.shiftleft(bit, k * len(columns) + len(columns) - 1 - i)
    return key


def along_curve(df: DataFrame, bounds: Bounds, partition_by: Sequence[str] = ()) -> DataFrame:
    """Rows range partitioned and sorted by partition columns and curve; a hot cell is split by a hash of the row."""
    keyed = df.withColumn("__curve", curve_key(bounds))
    hashable = [f.name for f in df.schema.fields if f.dataType.typeName() != "map"]
    ranged = keyed.repartitionByRange(*partition_by, "__curve", F.xxhash64(*hashable))
    return ranged.sortWithinPartitions(*partition_by, "__curve", *bounds).drop("__curve")
