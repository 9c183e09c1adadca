"""SparkSession helpers.

The library never creates a session inside a transform; jobs and tests call
``get_session`` once.  On a cluster the session comes from ``spark-submit``:
the UTC time zone and ANSI mode are pinned (results depend on them), the
execution settings in ``SQL_DEFAULTS`` are filled in only where the cluster
configuration leaves them unset.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the library's results depend on: dates in UTC, ANSI arithmetic, epoch
# columns annotated as nanosecond timestamps read as the INT64 they are.
SQL_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}

# Execution settings the plans are designed for (runtime broadcast conversion,
# partition coalescing, skew-join splitting); applied only where the cluster
# configuration does not set them.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "millpulse",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    configured = spark.sparkContext.getConf()
    for k, v in SQL_DEFAULTS.items():
        if not configured.contains(k):
            spark.conf.set(k, v)
    apply_sql_defaults(spark)
    return spark


def apply_sql_defaults(spark: SparkSession) -> None:
    """Pin the SQL settings the library's semantics depend on (time zone, ANSI, epochs)."""
    for k, v in SQL_REQUIRED.items():
        spark.conf.set(k, v)

