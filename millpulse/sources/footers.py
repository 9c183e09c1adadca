"""Counts answered from parquet footers, without reading a column.

Spark's own parquet reader pushes ``count(*)`` and ``count(column)`` down to row-group
metadata where the files are read through its second data source interface
(``PushedAggregation`` in the plan).  Sessions read parquet by the first one; here only
the reads that are to be counted go by the second.  Minima and maxima are not asked
for: the reader refuses row groups without values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millpulse.operators.quality import Check, aggregate_checks
from millpulse.sinks.snapshots import Snapshot, SnapshotStore

_V1 = "spark.sql.sources.useV1SourceList"
_PUSH = "spark.sql.parquet.aggregatePushdown"


def read_for_counts(spark: SparkSession, paths: Sequence[str], schema: StructType | None = None, base: str | None = None) -> DataFrame:
    """Files whose ungrouped counts come from footers; a filter on a column would make it an ordinary read."""
    saved = spark.conf.get(_V1)
    spark.conf.set(_PUSH, "true")
    spark.conf.set(_V1, ",".join(x for x in saved.split(",") if x != "parquet"))
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        if base is not None:
            reader = reader.option("basePath", base)
        return reader.parquet(*paths)
    finally:
        spark.conf.set(_V1, saved)


def _stored(store: SnapshotStore, table: str, snapshot: Snapshot) -> DataFrame:
    schema, paths = snapshot.schema(table), store.paths(table, snapshot)
    if not paths:
        return store.spark.createDataFrame([], schema)
    return read_for_counts(store.spark, paths, schema, f"{store.root}/data/{table}")


def not_null_checks(store: SnapshotStore, table: str, checks: Sequence[Check], snapshot: Snapshot | None = None) -> DataFrame:
    """D1 of a stored table: rows less values, by row-group counts; partition columns are never null but in the null folder."""
    df = _stored(store, table, snapshot or store.current())

    def nulls(column: str) -> Column:
        return F.count(F.lit(1)) - F.count(column)

    return aggregate_checks(df, [(table, c, nulls(c[0])) for c in checks if c[1] == "not_null"])


def row_counts(store: SnapshotStore, tables: Sequence[str], snapshot: Snapshot | None = None) -> DataFrame:
    """(table, row_count) of stored tables: from the manifest, or from footers where a batch is live in part."""
    snapshot = snapshot or store.current()
    known = [(t, snapshot.rows(t)) for t in tables]
    out = store.spark.createDataFrame([k for k in known if k[1] is not None], "table string, row_count bigint")
    for t, n in known:
        if n is None:
            out = out.unionByName(_stored(store, t, snapshot).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table"), "row_count"))
    return out
