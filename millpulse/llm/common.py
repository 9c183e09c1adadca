"""Scratch tables and grouping of sorted Arrow batches.

Joins that carry texts always shuffle (``shuffled``).  The others carry no hints:
Catalyst broadcasts a stored table only where its size is within
``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits skewed keys.
"""

from __future__ import annotations

import atexit
import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millpulse.sinks.scratch import shared_folder

_made: list[tuple[SparkSession, str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _delete_all() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone; the folder is scratch
            pass


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
        _made.append((spark, self.root))

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        _delete(self.spark, f"{self.root}/{name}")


def free_name(df: DataFrame, name: str) -> str:
    """``name`` for a new column, with underscores after it where the table has one of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffled(small: DataFrame) -> DataFrame:
    """The side of a join with whole texts: both sides are shuffled at every size.

    Left to its size, the join would change from a broadcast to a shuffle of the
    texts somewhere on the way up, and a small run would say nothing about a large one.
    """
    return small.hint("merge")


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column without nulls as numpy array."""
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 0) -> Iterator[pa.Table]:
    """Whole groups of batches sorted by ``keys``, one table each time.

    With ``rows`` a table holds consecutive whole groups of more than so many rows.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, dtype=bool)
        for k in keys:
            v = column(batch, k)
            change[1:] |= v[1:] != v[:-1]
            if held:
                change[0] |= v[0] != column(held[-1], k)[-1]
        starts, at = np.flatnonzero(change), 0
        while True:
            # the next group's start with enough rows before it
            k = int(np.searchsorted(starts, at + max(rows + 1 - size, 0 if size else 1)))
            if k == len(starts):
                break
            cut = int(starts[k])
            if cut > at:
                held.append(batch.slice(at, cut - at))
            yield pa.Table.from_batches(held)
            held, size, at = [], 0, cut
        held.append(batch.slice(at))
        size += n - at
    if held:
        yield pa.Table.from_batches(held)


def binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary column of consecutive slices of an array; ``ends`` counts elements, from 0 on."""
    raw = np.ascontiguousarray(values)
    offs = (np.asarray(ends, dtype=np.int64) * raw.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offs) - 1, [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(raw.tobytes())])


def binary_values(col: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(values, element offsets) of a binary column without nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offs[0] : offs[-1]] if raw is not None else np.zeros(0, np.uint8)
    item = np.dtype(dtype).itemsize
    return np.frombuffer(data.tobytes(), dtype=dtype), (offs - offs[0]) // item


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place): for each row repeated ``counts`` times, its index and the place within."""
    row = np.repeat(np.arange(len(counts)), counts)
    before = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else np.zeros(0, np.int64)
    return row, np.arange(len(row)) - before[row]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table; Python workers on this machine also look for the package where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (paths, root) if p)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")
