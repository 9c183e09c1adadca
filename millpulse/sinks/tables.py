"""Physical organisation of writes, day-partitioned tables, and tables in other layouts.

``rebalance`` lets adaptive execution split large and merge tiny partitions before a
write; sorting within partitions by the date and the cluster columns gives per-file
min/max ranges that parquet readers skip on.  Sets of tables that change as a whole
are in ``snapshots``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millpulse.operators.clustering import Bounds, along_curve
from millpulse.sources.files import file_schema

LOAD_YEAR = "load_year"


class LayoutError(ValueError):
    """A stored table cannot be replaced by year where it is."""


def organize(df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (), rebalance_by: Sequence[str] = (), curve: Bounds | None = None) -> DataFrame:
    """Rebalance (by the given columns, or evenly) and sort for clustering (K7, K8).

    ``curve``, bounds of several columns (``curve_bounds``), clusters by all of them alike.
    """
    if curve:
        return along_curve(df, curve, partition_by)
    df = df.hint("rebalance", *rebalance_by)
    keys = [*partition_by, *cluster_by]
    return df.sortWithinPartitions(*keys) if keys else df


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
    rows: Observation | None = None,
    dynamic: bool = False,
    rebalance_by: Sequence[str] = (),
    metrics: dict[str, Column] | None = None,
    curve: Bounds | None = None,
) -> None:
    """Write a (partitioned, clustered) table.

    ``dynamic`` replaces only the partitions present in ``df`` (at commit);
    otherwise an overwrite replaces the whole path.  ``rows`` (K9) observes the
    written row count, and the aggregates ``metrics``, in the write's result stage, where
    Spark applies each task's metric update once even when tasks or stages are retried.
    """
    out = organize(df, partition_by, cluster_by, rebalance_by, curve)
    if rows is not None:
        out = out.observe(rows, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (metrics or {}).items()])
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def table_layout(spark: SparkSession, root: str) -> str:
    """What is stored at ``root``.

    absent       no data file
    other_years  rows of several batches (a ``load_year``, ``year`` or ``date`` column)
    unknown      none of these columns
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = file_schema(spark, root) if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) else None
    if found is None:
        return "absent"
    names = set(found.fieldNames())
    return "other_years" if names & {LOAD_YEAR, "year", "date"} else "unknown"


def check_layouts(spark: SparkSession, roots: Sequence[str]) -> dict[str, str]:
    """Layouts of folders outside a store; raises where rows of other years would be lost sight of."""
    layouts = {root: table_layout(spark, root) for root in roots}
    bad = [root for root, layout in layouts.items() if layout == "other_years"]
    if bad:
        raise LayoutError("tables outside the store hold other years; take them in with adopt_table first: " + ", ".join(bad))
    return layouts


def replace_days(df: DataFrame, root: str, date_col: str = "date", cluster_by: Sequence[str] = ()) -> None:
    """K1: in a day-partitioned table, replace only the days present in ``df``."""
    write_table(df, root, [date_col], cluster_by, dynamic=True, rebalance_by=[date_col])
