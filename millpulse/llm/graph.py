"""Connected components of an edge table, by large-star and small-star rounds.

Each round joins the edges with every node's least neighbour, found by a
partially aggregated minimum: no group of edges is collected, and a hub of any
degree is split by adaptive skew joins.  The rounds end when every edge leads
to its component's least node (logarithmic in the usual case).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _least(df: DataFrame) -> DataFrame:
    return df.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    joined = e.join(_least(e), "u")
    return joined.select("u", F.col("m").alias("v")).union(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, root): each node of ``edges`` (u, v long) and the least node it reaches.

    Repeated edges, self-loops and empty input are allowed; nodes without an
    edge to another node are not returned.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = scratch.table(e, f"{name}-0")
    mark, i = _mark(e), 0
    while mark[0]:
        i += 1
        e2 = scratch.table(_small_star(_large_star(e)), f"{name}-{i}")
        scratch.drop(f"{name}-{i - 1}")
        e, before, mark = e2, mark, _mark(e2)
        if mark == before:
            break
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
