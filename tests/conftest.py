from __future__ import annotations

import contextlib
import datetime as dt
import io
import math
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"
SF_SMALL = f"{TESTDATA}/sf0.001"
SF_ORACLE = f"{TESTDATA}/sf0.01"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="session")
def spark():
    from millpulse.session import get_session

    s = get_session(
        master="local[*]",
        shuffle_partitions=8,
        extra={"spark.driver.memory": "8g", "spark.sql.execution.arrow.pyspark.enabled": "true"},
    )
    yield s
    s.stop()


@contextlib.contextmanager
def threshold(spark, value):
    """Run under a broadcast threshold: -1 takes the shuffle path."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, str(value))
    try:
        yield
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"  # distinct from NULL
        return v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare_with_oracle(spark_df, sql: str, sf_dir: str):
    """Row count, column names and order-insensitive exact values must match."""
    con = duck(sf_dir)
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    scols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    assert sorted(scols) == sorted(ocols), (sorted(scols), sorted(ocols))
    assert len(srows) == len(orows), (len(srows), len(orows))
    a, b = rows_of(scols, srows), rows_of(ocols, orows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    assert not bad, f"{len(bad)} differing rows, first: {bad[:2]} (cols {sorted(scols)})"
    return len(srows)
