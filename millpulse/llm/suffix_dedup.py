"""Operator 9: repeated byte strings, by suffix arrays with induced sorting.

Shards are made by content: a 400-byte string goes to the shard of its winnowed
anchor (see ``seeds``), so all copies of a string meet in one shard wherever
they are in the corpus, and only text around anchors that occur twice is
sorted at all.  A shard's text is the concatenation of its distinct segments.
Its suffix array is built by induced sorting (``suffix.suffix_array``); for
every string start, in text order, the permuted common prefix with the suffix
sorted just before decides whether it continues a run of equal strings
(prefixes are computed up to the window, which is all that the decision needs).
A start is repeated if its run holds two or more occurrences.

Defined cases: null text is empty.  Texts of fewer than ``window`` bytes keep
all.  Matches never cross texts; matches within one text and overlapping ones
count.  Cuts may split a character: the kept bytes are hashed as they are, and
``kept_bytes`` is binary.  Repeated rows are documents of their own.  Only the
id and the text column are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops as tx
from .common import Scratch, binary_values, groups, spread
from .seeds import MASKS, Units, group_weights, grouped, masks_of, repeated_spans, repeated_starts, with_spans
from .suffix import previous_in_order, suffix_array

WINDOW = 400
GRAM = 48
#: Distinct segments of an anchor from which they are cut, and windows in a range.
HOT = 8192
CUT = 32
#: Segments sorted together (about 600 bytes each).
GROUP_ROWS = 4096


def repeated_in_shard(data: np.ndarray, ends: np.ndarray, weight: np.ndarray, window: int) -> np.ndarray:
    """For every window of every text of a shard, whether it occurs twice or more (by weight)."""
    length = np.diff(ends)
    row, at = spread(length)
    # symbols: 0 ends the shard, 1 ends a text, bytes from 2 on
    place = ends[:-1][row] + row + at
    t = np.ones(len(data) + len(length) + 1, dtype=np.int32)
    t[place] = data.astype(np.int32) + 2
    t[-1] = 0
    sa = suffix_array(t, 258).astype(np.int64)
    before = previous_in_order(sa)
    full = np.zeros(len(t), dtype=bool)
    full[place] = at <= length[row] - window
    starts = np.flatnonzero(full)
    windows = tx.Rolling(tx.BYTE_VALUES[data])
    offset = np.zeros(len(t), dtype=np.int64)
    offset[place] = np.arange(len(data))
    ident = np.zeros(len(t), dtype=np.uint64)
    ident[starts] = windows.slices(offset[starts], offset[starts] + window)
    # permuted common prefix, up to the window: whole or not
    prefix = np.zeros(len(t), dtype=bool)
    phi = before[starts]
    prefix[starts] = (phi >= 0) & full[phi] & (ident[starts] == ident[phi])
    in_order = sa[full[sa]]
    head = np.flatnonzero(~prefix[in_order])
    owner = np.zeros(len(t), dtype=np.int64)
    owner[place] = row
    w = weight[owner[in_order]]
    total = np.repeat(np.add.reduceat(w, head), np.diff(np.append(head, len(in_order)))) if len(in_order) else w
    hit = np.zeros(len(t), dtype=bool)
    hit[in_order] = total > 1
    return hit[starts]


def sort_shards(segments: DataFrame, window: int) -> DataFrame:
    """The masks of strings found more than once, from pieces with bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches, ["anchor", "slice"], GROUP_ROWS):
            data, ends = binary_values(part.column("payload"), np.uint8)
            weight = group_weights(part)
            hit = repeated_in_shard(data, ends, weight, window)
            yield from masks_of(part, hit, np.diff(ends) - window + 1, weight)

    return grouped(segments).mapInArrow(run, MASKS)


def kept_bytes(docs: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, offs in tx.text_blocks(batch.column(2)):
                n = np.diff(offs)
                row, start = repeated_starts(batch.column(3).slice(i, len(n)))
                kept, spans = [], np.zeros(len(n), dtype=np.int64)
                if len(row):
                    gone = tx.cover(offs[row] + start, window, len(data))
                    for d in range(len(n)):
                        mine = gone[offs[d] : offs[d + 1]]
                        spans[d] = len(tx.runs(mine)[0])
                        kept.append(data[offs[d] : offs[d + 1]][~mine].tobytes())
                else:
                    kept = [data[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:], strict=True)]
                rows = batch.slice(i, len(n))
                removed = n - np.array([len(k) for k in kept])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(spans), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"],
                )

    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("kept_bytes", T.BinaryType())])
    return docs.select("id", "h", "text", "spans").mapInArrow(run, schema)


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes."""
    units = Units(False, window, gram, HOT, CUT)
    scratch = Scratch(docs.sparkSession, "suffix")
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    spans = repeated_spans(docs, units, lambda segments: sort_shards(segments, window), scratch)
    return kept_bytes(with_spans(docs, spans), window).withColumnRenamed("id", id_col)
