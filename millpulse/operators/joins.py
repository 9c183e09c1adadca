"""Lookup (dimension) joins that need no job of their own.

``lookup_join(fact, dim, fact_key, dim_key)`` is a LEFT equi-join of a small
table onto a large one (the enrichment joins J1-J4 and M3's forecast).  Whether
the dimension is broadcast is Catalyst's decision, from the measured size of its
files and ``spark.sql.autoBroadcastJoinThreshold``; nothing is counted while the
plan is built, and a dimension whose columns nobody uses costs nothing.

On the shuffle path, fact rows whose key is NULL can never match, but hash
partitioning would send all of them to one reducer.  Their join key is replaced
by one of ``null_spread`` sentinel values (a hash of the row's identity
columns; by default as many as shuffle partitions), and an ``IS NOT NULL`` guard
in the join condition keeps a sentinel from matching.  Hot keys that are not
NULL are split by adaptive skew joins, which apply to the fact (left) side of a
left outer join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_NULL_SPREAD = 64
_SPREAD = "__null_spread"
_SPREADABLE = (T.StringType, T.LongType, T.IntegerType)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    *,
    spread_by: list[str] | None = None,
    null_spread: int | None = None,
    broadcast: bool = False,
) -> DataFrame:
    """LEFT JOIN ``dim`` ON fact_key = dim_key; the dim key column is dropped.

    Fan-out is kept as in SQL: a dim key present twice doubles the fact row.
    ``broadcast`` is for dimensions of a structurally bounded size only.
    ``null_spread`` defaults to the session's shuffle partition count (at least
    ``DEFAULT_NULL_SPREAD``), so NULL keys can use every reducer.
    """
    rk = f"__rk_{dim_key}"
    d = dim.where(F.col(dim_key).isNotNull()).withColumnRenamed(dim_key, rk)
    if broadcast:
        return fact.join(F.broadcast(d), F.col(fact_key) == F.col(rk), "left").drop(rk)
    key_type = fact.schema[fact_key].dataType
    if not spread_by or not isinstance(key_type, _SPREADABLE):
        return fact.join(d, F.col(fact_key) == F.col(rk), "left").drop(rk)
    if null_spread is None:
        partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        null_spread = max(DEFAULT_NULL_SPREAD, partitions)
    sentinel = F.pmod(F.xxhash64(*spread_by), F.lit(null_spread))
    if isinstance(key_type, T.StringType):
        sentinel = F.concat(F.lit("\u0000null-"), sentinel.cast("string"))
    else:
        sentinel = (F.lit(-1) - sentinel).cast(key_type)
    f = fact.withColumn(_SPREAD, F.coalesce(F.col(fact_key), sentinel))
    cond = (F.col(_SPREAD) == F.col(rk)) & F.col(fact_key).isNotNull()
    return f.join(d, cond, "left").drop(rk, _SPREAD)
