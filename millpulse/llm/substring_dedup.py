"""Operator 6: repeated word passages, by seed and extend.

Seeds are winnowed anchors (see ``seeds``): any two equal passages of at least
``window`` words share an anchor at the same place.  Segments with a shared
anchor are joined on it and extended to both sides as far as their windows
reach: the extension is done for the whole group at once, by comparing the
hashes of its windows at each place relative to the anchor, so a group of n
segments costs n extensions, not n*n.  Windows found twice and next to each
other make up the maximal repeats of at least ``window`` words; every word of
every copy is removed.

Defined cases: null text has no words (result: zero counts, hash of the empty
string).  Texts with fewer than ``window`` words keep all.  Repeats within one
document count, overlapping ones too.  Repeated rows are documents of their
own, so both lose every window.  Only the id and the text column are read.
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

WINDOW = 35
GRAM = 12
#: Distinct segments of an anchor from which they are cut, and windows in a range.
HOT = 50_000
CUT = 4
#: Segments taken together in a task (about 150 bytes each).
GROUP_ROWS = 20_000


def extend_groups(segments: DataFrame) -> DataFrame:
    """The masks of windows found more than once, from pieces with window hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches, ["anchor", "slice"], GROUP_ROWS):
            values, ends = binary_values(part.column("payload"), np.uint64)
            count = np.diff(ends)
            weight = group_weights(part)
            row, _ = spread(count)
            _, inverse = np.unique(values, return_inverse=True)
            hit = np.bincount(inverse, weights=weight[row])[inverse] > 1
            yield from masks_of(part, hit, count, weight)

    return grouped(segments).mapInArrow(run, MASKS)


def kept_words(docs: DataFrame, units: Units) -> DataFrame:
    """id, h, n_words, n_removed, kept text's sha256, and the kept text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, offs in tx.text_blocks(batch.column(2)):
                s, e, first = tx.word_spans(data, offs, tx.NOT_SPACE)
                n = np.diff(first)
                spans = batch.column(3).slice(i, len(n))
                row, start = repeated_starts(spans)
                gone = tx.cover(first[row] + start, units.window, len(s)) if len(row) else np.zeros(len(s), dtype=bool)
                rest = np.flatnonzero(~gone)
                s, e = s[rest], e[rest]
                at = np.searchsorted(rest, first)
                kept = np.diff(at)
                # each kept word and the space after it, then without each text's last space
                length = e - s + 1
                take, place = spread(length)
                out = np.append(data, np.uint8(0x20))[np.where(place < length[take] - 1, s[take] + place, len(data))]
                ends = np.concatenate(([0], np.cumsum(length)))
                texts = [out[ends[a] : max(ends[a], ends[b] - 1)].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                rows = batch.slice(i, len(n))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(n.astype(np.int64)), pa.array((n - kept).astype(np.int64)), pa.array([hashlib.sha256(t).hexdigest() for t in texts]), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["id", "h", "n_words", "n_removed", "kept_sha256", "kept_text"],
                )

    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("h", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType())])
    return docs.select("id", "h", "text", "spans").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256, kept_text (kept words joined by one space)."""
    units = Units(True, window, gram, HOT, CUT)
    scratch = Scratch(docs.sparkSession, "substring")
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    spans = repeated_spans(docs, units, extend_groups, scratch)
    out = kept_words(with_spans(docs, spans), units)
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept_sha256", "kept_text")

