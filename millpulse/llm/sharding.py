"""Operator 13: shards cut from a Hilbert curve over metadata, so that files prune in several dimensions.

Each dimension (a column of numbers, strings or dates) is quantised to ``2 ** bits``
bins of about equal row counts: its distinct values are counted and put in order,
and a value's bin is the share of rows before it.  Bounds of bins, a few values a
dimension, are all that reaches the driver.  A document's cell gets its place on
the Hilbert curve; rows are sorted by it and the order is cut into runs, of equal
row counts (law ``rows``: at most one apart) or of equal sizes (law ``bytes``: cuts at
equal shares of all bytes, so a shard is off by less than a document).  A cell is a small box in all
dimensions and runs of the curve are joined boxes: a shard's files hold a short
range of every dimension, so a filter on any of them skips files.

The global order is a range partitioning; a row's rank is its place in its partition
and the count of those before.  No group is gathered: rows of one cell are ordered
by the text's checksum (equal texts are neighbours), the id, and their place in
the input, so that one hot value, text or id is split like any others.

Defined cases: a null value of a dimension is below all others; a null text has no
bytes and checksum 0; an empty one the same.  Null ids take part.  Repeated rows
get places of their own.  With fewer rows than shards some shards stay empty.
Empty table: no rows.  Other columns may have any names: they stay in ``row``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch

SHARDS = 24
BITS = 5
#: Bytes of a document beside its text.
OVERHEAD = 8
#: A row's number in its partition is in the low bits of ``monotonically_increasing_id``.
PLACE_BITS = 33


def hilbert(axes: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells, given by ``bits``-bit coordinates (Skilling's transposition)."""
    x = [np.asarray(a).astype(np.int64) for a in axes]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        below = q - 1
        for i in range(len(x)):
            inside = (x[i] & q) != 0
            x[0] ^= np.where(inside, below, 0)
            swap = np.where(inside, 0, (x[0] ^ x[i]) & below)
            x[0] ^= swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[-1])
    q = top
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for a in x:
            place = (place << 1) | (((a ^ flip) >> b) & 1)
    return place


def _curve(bins: list[Column], bits: int) -> Column:
    @F.pandas_udf("long")
    def place(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert([cells[c].to_numpy() for c in cells.columns], bits))

    return place(F.struct(*[b.alias(f"d{i}") for i, b in enumerate(bins)]))


def in_order(df: DataFrame, order: Sequence[str], weight: Column, scratch: Scratch, name: str) -> DataFrame:
    """df, sorted over all partitions, with ``rank`` (rows before) and ``before`` (weight before)."""
    ranged = df.withColumn("weight", weight).repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    rows = scratch.table(ranged.withColumn("at", place), f"{name}-rows")
    part = F.shiftright("at", PLACE_BITS)
    sums = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    # one row a partition: their running sums are small enough for one task
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in ("n", "w")])
    starts = scratch.table(starts, f"{name}-starts")
    inner = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.withColumn("part", part).join(starts, "part")
    rank = F.col("n0") + F.col("at").bitwiseAND((1 << PLACE_BITS) - 1)
    before = F.col("w0") + F.coalesce(F.sum("weight").over(inner), F.lit(0))
    return joined.withColumns({"rank": rank, "before": before}).drop("part", "at", "n0", "w0", "weight")


def bounds(df: DataFrame, dim: str, bits: int, rows: int, scratch: Scratch) -> list[tuple[object, int]]:
    """(least value, bin) of the bins of a dimension; at most ``2 ** bits``, nulls not among them."""
    counts = df.groupBy(F.col(dim).alias("value")).agg(F.count("*").alias("n"))
    ranked = in_order(counts, ["value"], F.col("n"), scratch, f"values-{dim}")
    bin_ = F.floor(F.col("before") * F.lit(1 << bits) / F.lit(max(rows, 1))).cast("int")
    found = ranked.where("value is not null").groupBy(bin_.alias("bin")).agg(F.min("value").alias("value")).orderBy("bin")
    return [(r["value"], r["bin"]) for r in found.collect()]


def _bin(dim: Column, found: list[tuple[object, int]]) -> Column:
    out = F.lit(0)
    for value, bin_ in found:
        out = F.when(dim >= F.lit(value), F.lit(bin_)).otherwise(out)
    return F.coalesce(out, F.lit(0)).cast("long")


def shard_documents(docs: DataFrame, dims: Sequence[str] = ("lang", "source", "n_chars"), shards: int = SHARDS, law: str = "rows",
                    id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] | None = None, bits: int = BITS) -> DataFrame:
    """(row, size, text_crc32, curve, law, shard, slot): a row for each of docs.

    ``row`` is a struct of the columns ``keep`` (all if None).  ``slot`` counts a
    shard's rows from 0 in curve order.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"law is rows or bytes, not {law}")
    if not dims or bits * len(dims) > 62:
        raise ValueError("one dimension at least, and at most 62 bits for all of them")
    scratch = Scratch(docs.sparkSession, "sharding")
    raw = F.coalesce(F.encode(docs[text_col], "utf-8"), F.lit(b""))
    row = F.struct(*[docs[c] for c in (docs.columns if keep is None else keep)])
    flat = docs.select(
        row.alias("row"), docs[id_col].alias("id"), F.monotonically_increasing_id().alias("nth"),
        (F.length(raw).cast("long") + OVERHEAD).alias("size"), F.crc32(raw).alias("text_crc32"),
        *[docs[d].alias(f"dim{i}") for i, d in enumerate(dims)],
    )
    flat = scratch.table(flat, "documents")
    total = flat.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    bins = [_bin(F.col(f"dim{i}"), bounds(flat, f"dim{i}", bits, total["rows"], scratch)) for i in range(len(dims))]
    placed = flat.withColumn("curve", _curve(bins, bits))
    ranked = in_order(placed, ["curve", "text_crc32", "size", "id", "nth"], F.col("size"), scratch, "order")
    done = F.col("rank") if law == "rows" else F.col("before")
    cut = F.floor(done.cast("decimal(28,0)") * F.lit(shards) / F.lit(max(total[law] or 0, 1)).cast("decimal(28,0)")).cast("int")
    cut = scratch.table(ranked.withColumn("shard", cut).select("row", "size", "text_crc32", "curve", F.lit(law).alias("law"), "shard", "rank"), "shards")
    first = cut.groupBy("shard").agg(F.min("rank").alias("first"))  # a row a shard
    return cut.join(F.broadcast(first), "shard").select("row", "size", "text_crc32", "curve", "law", "shard", (F.col("rank") - F.col("first")).alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """Files of whole rows: a folder for each shard, its rows in curve order."""
    ordered = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.select("row.*", F.col("shard").alias("_shard")).write.partitionBy("_shard").parquet(path)
