"""Winnowed seeds: bring equal windows of all documents together, exactly.

A window is L consecutive units (words or bytes).  Every window selects the
least of its k-unit grams as its anchor; equal windows select equal anchors.
The consecutive windows of a document that select the same anchor occurrence
form a segment (at most L-k+1 windows).  So windows need only be compared
between segments with the same anchor, and equal segments need to be compared
once.

  occurrences  (anchor, segment hash, id, text hash, start, windows, lead) of all documents
  shared       those whose anchor occurs at least twice in the corpus
  distinct     one representative and the number of occurrences per (anchor, segment)
  found        per distinct segment, which of its windows start anywhere else
               (the operator's own step)
  spans        per document, its segments with repeated windows

All steps are partially aggregated counts and equi-joins whose size is linear
in the corpus; no pair of documents is formed and no group of rows is gathered
but the segments of one document.

An anchor with more than ``hot`` distinct segments would make a large group.
Its segments are cut into ranges of ``cut`` windows at fixed distances from the
anchor, and dealt by the content that all windows of the range have in common:
equal windows still meet, other segments of the anchor no longer do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops as tx
from .common import Scratch, binary, binary_values, shuffled, spread


@dataclass(frozen=True)
class Units:
    """What a window is made of."""

    by_word: bool
    window: int
    gram: int
    hot: int
    cut: int

    def sequence(self, data: np.ndarray, offs: np.ndarray) -> tuple[tx.Rolling, np.ndarray, np.ndarray, np.ndarray]:
        """(rolling hashes, first unit of each text, unit starts, unit ends)."""
        if self.by_word:
            s, e, first = tx.word_spans(data, offs, tx.NOT_SPACE)
            return tx.sequence(tx.word_hashes(data, s, e)), first, s, e
        at = np.arange(len(data) + 1)
        return tx.Rolling(tx.BYTE_VALUES[data]), offs, at[:-1], at[1:]


def find_segments(units: Units, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, windows, lead, anchor, segment hash) of a block's segments.

    ``start`` counts units of the text, ``lead`` those from there to the anchor.
    """
    rolled, first, _, _ = units.sequence(data, offs)
    n = int(first[-1])
    ok = tx.inside(first, n, units.window)
    starts = np.flatnonzero(ok)
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    grams = rolled.every(units.gram)
    anchor = tx.winnow(grams, units.window - units.gram + 1)[starts]
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1))))
    begin, count = starts[new], np.diff(np.append(new, len(starts)))
    text = np.searchsorted(first, begin, side="right") - 1
    return text, begin - first[text], count, anchor[new] - begin, grams[anchor[new]], rolled.slices(begin, begin + count + units.window - 1)


def occurrences(docs: DataFrame, units: Units) -> DataFrame:
    """Segments of all documents (id, h, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, offs in tx.text_blocks(batch.column(2)):
                text, start, count, lead, anchor, segment = find_segments(units, data, offs)
                at = pa.array(text + i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(segment.view(np.int64)), batch.column(0).take(at), batch.column(1).take(at), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int16)), pa.array(lead.astype(np.int16))],
                    names=["anchor", "segment", "id", "h", "start", "count", "lead"],
                )

    fields = [T.StructField("anchor", T.LongType()), T.StructField("segment", T.LongType()), T.StructField("id", docs.schema["id"].dataType), T.StructField("h", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("count", T.ShortType()), T.StructField("lead", T.ShortType())]
    return docs.select("id", "h", "text").mapInArrow(run, T.StructType(fields))


def pieces(units: Units, rolled: tx.Rolling, begin: np.ndarray, count: np.ndarray, lead: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(segment, offset, count, slice) of the pieces; a segment that is not hot is one piece."""
    top = np.where(hot, lead // units.cut, 0)
    low = np.where(hot, (lead - count + 1) // units.cut, 0)
    row, k = spread(top - low + 1)
    j, h = top[row] - k, hot[row]
    a = np.where(h, np.maximum(0, lead[row] - (j + 1) * units.cut + 1), 0)
    b = np.where(h, np.minimum(count[row], lead[row] - j * units.cut + 1), count[row])
    anchor = begin[row] + lead[row]
    core = np.where(h, anchor - j * units.cut, 0)
    end = np.where(h, core - units.cut + 1 + units.window, 0)
    content = tx.mix(rolled.slices(core, end) ^ j.astype(np.uint64))
    return row, a, b - a, np.where(h, content, np.uint64(0))


def segment_texts(docs: DataFrame, units: Units) -> DataFrame:
    """(anchor, slice, segment, n, off, count, payload): the pieces of representatives.

    Input rows have ``wanted``, an array of (anchor, segment, n, start, count,
    lead, hot).  The payload holds a piece's window hashes (words) or its bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, offs in tx.text_blocks(batch.column(1)):
                wanted = batch.column(0).slice(i, len(offs) - 1)
                flat, many = wanted.flatten(), np.diff(wanted.offsets.to_numpy())
                text, _ = spread(many)
                get = {f.name: flat.field(f.name) for f in flat.type}
                number = {k: get[k].to_numpy().astype(np.int64) for k in ("start", "count", "lead")}
                rolled, first, _, _ = units.sequence(data, offs)
                begin = first[text] + number["start"]
                owner, off, count, part = pieces(units, rolled, begin, number["count"], number["lead"], get["hot"].to_numpy(zero_copy_only=False))
                length = count if units.by_word else count + units.window - 1
                row, at = spread(length)
                at = (begin[owner] + off)[row] + at
                payload = binary(rolled.slices(at, at + units.window) if units.by_word else data[at], np.concatenate(([0], np.cumsum(length))))
                which = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [get["anchor"].take(which), pa.array(part.view(np.int64)), get["segment"].take(which), get["n"].take(which), pa.array(off.astype(np.int16)), pa.array(count.astype(np.int16)), payload],
                    names=["anchor", "slice", "segment", "n", "off", "count", "payload"],
                )

    return docs.select("wanted", "text").mapInArrow(run, "anchor long, slice long, segment long, n long, off short, count short, payload binary")


def grouped(segments: DataFrame) -> DataFrame:
    """Pieces that may hold equal windows, next to each other."""
    return segments.repartition("anchor", "slice").sortWithinPartitions("anchor", "slice")


def group_weights(part: pa.Table) -> np.ndarray:
    """Occurrences of each piece; 0 for one that came before (a representative that is a repeated row)."""
    key = np.stack([part.column(k).to_numpy().astype(np.int64) for k in ("anchor", "segment", "off")], 1)
    _, once = np.unique(key, axis=0, return_index=True)
    weight = np.zeros(len(key), dtype=np.int64)
    weight[once] = part.column("n").to_numpy()[once]
    return weight


MASKS = "anchor long, segment long, off short, count short, mask binary"


def masks_of(part: pa.Table, hit: np.ndarray, count: np.ndarray, weight: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of MASKS for the pieces with a repeated window; ``hit`` has a flag for each window of each piece."""
    row, _ = spread(count)
    keep = (np.bincount(row, weights=hit, minlength=len(count)) > 0) & (weight > 0)
    rows = np.flatnonzero(keep)
    if len(rows):
        at = pa.array(rows)
        cols = [part.column(k).take(at).combine_chunks() for k in ("anchor", "segment", "off", "count")]
        cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
        yield pa.RecordBatch.from_arrays([*cols, mask_column(hit[keep[row]], count[rows])], names=["anchor", "segment", "off", "count", "mask"])


def mask_column(hit: np.ndarray, count: np.ndarray) -> pa.Array:
    """One bit for each window of each segment, a whole number of bytes per segment."""
    size = (count + 7) // 8
    row, at = spread(count)
    bits = np.zeros(int(size.sum()) * 8, dtype=bool)
    ends = np.concatenate(([0], np.cumsum(size)))
    bits[ends[row] * 8 + at] = hit
    return binary(np.packbits(bits), ends)


def repeated_starts(spans: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of the repeated windows of a column of arrays of (start, count, mask)."""
    flat = spans.flatten()
    owner, _ = spread(np.diff(spans.offsets.to_numpy()))
    if not len(flat):
        return owner, owner
    bits, ends = binary_values(flat.field("mask"), np.uint8)
    bits = np.unpackbits(bits)
    count = flat.field("count").to_numpy().astype(np.int64)
    row, at = spread(count)
    hit = bits[ends[row] * 8 + at].astype(bool)
    row, at = row[hit], at[hit]
    return owner[row], flat.field("start").to_numpy().astype(np.int64)[row] + at


def repeated_spans(docs: DataFrame, units: Units, found: Callable[[DataFrame], DataFrame], scratch: Scratch) -> DataFrame:
    """(id, h, spans): documents of (id, h, text) with windows that start anywhere else.

    ``found`` maps pieces (``segment_texts``) to the masks of their repeated windows (``MASKS``).
    """
    occ = scratch.table(occurrences(docs, units), "occurrences")
    often = occ.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor")
    shared = scratch.table(occ.join(often, "anchor", "left_semi"), "shared")
    scratch.drop("occurrences")
    place = F.struct("id", "h", "start", "count", "lead")
    distinct = shared.groupBy("anchor", "segment").agg(F.count("*").alias("n"), F.min(place).alias("rep"))
    distinct = scratch.table(distinct.select("anchor", "segment", "n", "rep.*"), "distinct")
    hot = scratch.table(distinct.groupBy("anchor").agg(F.count("*").alias("c")).where(F.col("c") > units.hot).select("anchor", F.lit(True).alias("hot")), "hot")
    marked = distinct.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    one = F.struct("anchor", "segment", "n", "start", "count", "lead", "hot")
    wanted = marked.groupBy(F.col("id").alias("rid"), F.col("h").alias("rh")).agg(F.collect_list(one).alias("wanted"))
    wanted = scratch.table(wanted, "wanted")
    sources = docs.join(shuffled(wanted), docs["id"].eqNullSafe(wanted["rid"]) & (docs["h"] == wanted["rh"]))
    masks = scratch.table(found(segment_texts(sources, units)), "masks").withColumnRenamed("count", "many")
    span = F.struct((F.col("start") + F.col("off")).alias("start"), F.col("many").alias("count"), "mask")
    spans = shared.join(masks, ["anchor", "segment"]).groupBy("id", "h").agg(F.collect_set(span).alias("spans"))
    spans = scratch.table(spans, "spans")
    scratch.drop("shared")
    return spans


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs (id, h, text) with their spans, null where there are none."""
    s = spans.select(F.col("id").alias("sid"), F.col("h").alias("sh"), "spans")
    return docs.join(shuffled(s), docs["id"].eqNullSafe(s["sid"]) & (docs["h"] == s["sh"]), "left").select("id", "h", "text", "spans")
