"""Steps side by side, and clustering by two columns."""

from __future__ import annotations

import glob
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millpulse.operators.clustering import along_curve, curve_bounds, curve_key
from millpulse.plans.steps import StepsFailed, run_steps
from millpulse.sinks.tables import organize, write_table


def test_steps_overlap_and_follow_their_edges(spark):
    meet = threading.Barrier(3, timeout=60)  # three steps have to be running at once
    seen = []

    def job(name, wait):
        def run(done):
            if wait:
                meet.wait()
            seen.append((name, set(done)))
            return spark.range(10).count()

        return run

    steps = {"a": ((), job("a", True)), "b": ((), job("b", True)), "c": ((), job("c", True)), "d": (("a", "b"), job("d", False))}
    assert run_steps(spark, steps) == dict.fromkeys("abcd", 10)
    assert seen[-1][0] == "d" and {"a", "b"} <= seen[-1][1]


def test_a_failing_step_stops_only_its_dependants(spark):
    def fail(done):
        return spark.range(1).select(F.raise_error(F.lit("broken"))).collect()

    steps = {"bad": ((), fail), "after": (("bad",), lambda done: 1), "later": (("after",), lambda done: 1), "other": ((), lambda done: spark.range(5).count()), "beside": (("other",), lambda done: done["other"] + 1)}
    with pytest.raises(StepsFailed) as exc:
        run_steps(spark, steps)
    assert list(exc.value.errors) == ["bad"] and exc.value.done == {"other": 5, "beside": 6} and exc.value.skipped == ["after", "later"]


def test_steps_keep_the_sessions_properties(spark):
    spark.sparkContext.setLocalProperty("test.property", "kept")
    try:
        got = run_steps(spark, {"x": ((), lambda done: (spark.sparkContext.getLocalProperty("test.property"), spark.sparkContext.getLocalProperty("spark.scheduler.pool")))})
    finally:
        spark.sparkContext.setLocalProperty("test.property", None)
    assert got["x"] == ("kept", "x") and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def _grid(spark):
    """Readings of 40 machines in 40 categories, a third of them in one cell; some nulls."""
    hot = F.col("id") % 3 == 0
    return spark.range(48_000).select(
        F.lit("2025-01-01").cast("date").alias("day"),
        F.when(hot, "m07").otherwise(F.format_string("m%02d", F.xxhash64("id") % 20 + 20)).alias("machine"),
        F.when(hot, "c07").when(F.col("id") % 97 == 1, None).otherwise(F.format_string("c%02d", F.xxhash64("id", F.lit(1)) % 20 + 20)).alias("category"),
        "id",
    )


def _touched(path, column, value):
    """Files and rows that a filter on a column's value has to read, by the ranges in the footers."""
    files = rows = 0
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).name for i in range(len(meta.schema))].index(column)
        hit = [g for g in range(meta.num_row_groups) if (s := meta.row_group(g).column(at).statistics) and s.has_min_max and s.min <= value <= s.max]
        files += bool(hit)
        rows += sum(meta.row_group(g).num_rows for g in hit)
    return files, rows


def test_second_column_skips_files_along_the_curve(spark, tmp_path):
    df = _grid(spark)
    bounds = curve_bounds(df, ["machine", "category"])
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled")
    saved = {k: spark.conf.get(k) for k in keys}
    for k, v in zip(keys, ("16", "false", "false"), strict=True):
        spark.conf.set(k, v)
    try:
        write_table(df, f"{tmp_path}/sorted", ["day"], ["machine", "category"])
        write_table(df, f"{tmp_path}/curve", ["day"], ["machine", "category"], curve=bounds)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    before, after = (_touched(f"{tmp_path}/{x}", "category", "c31") for x in ("sorted", "curve"))
    assert before[0] >= 15 and after[0] <= before[0] // 2 and after[1] <= before[1] // 2
    first = [_touched(f"{tmp_path}/{x}", "machine", "m31") for x in ("sorted", "curve")]
    assert first[1][0] <= first[0][0] // 2
    a, b = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("sorted", "curve"))
    assert a.count() == b.count() == 48_000 and b.exceptAll(a.select(b.columns)).isEmpty()
    # the hot cell is not one file
    sizes = sorted(pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/curve/**/*.parquet", recursive=True))
    assert sizes[-1] < 6_000


def test_curve_key_interleaves_ranks(spark):
    bounds = {"a": [0, 1, 2, 3], "b": [0, 1, 2, 3]}
    cells = spark.sql("SELECT a, b FROM range(-1, 4) AS x(a), range(-1, 4) AS y(b)").withColumn("k", curve_key(bounds, bits=2))
    got = {(r["a"], r["b"]): r["k"] for r in cells.collect()}

    def z(a, b):
        ra, rb = (min(x + 1, 4) * 3 // 4 for x in (a, b))
        return sum((((ra >> k) & 1) << (2 * k + 1)) | (((rb >> k) & 1) << (2 * k)) for k in range(2))

    assert got == {(a, b): z(a, b) for a in range(-1, 4) for b in range(-1, 4)}
    nulls = spark.sql("SELECT CAST(NULL AS INT) AS a, 3 AS b").withColumn("k", curve_key(bounds, bits=2)).first()
    assert nulls["k"] == z(-1, 3)


def test_curve_of_tables_without_rows_or_values(spark):
    empty = spark.createDataFrame([], "a string, b int, d date")
    assert curve_bounds(empty, ["a", "b"]) == {"a": [], "b": []}
    nothing = spark.createDataFrame([(None, None, None)] * 3, "a string, b int, d date")
    bounds = curve_bounds(nothing, ["a", "b"])
    assert along_curve(nothing, bounds, ["d"]).count() == 3
    assert organize(nothing, ["d"], ["a", "b"], curve=bounds).columns == ["a", "b", "d"]
