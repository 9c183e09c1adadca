"""Operator 7: benchmark decontamination with an FM-index per training shard.

The test phrases are all windows of ``window`` consecutive words of each
benchmark item (a shorter item is one window).  Each task indexes its shard of
the training texts block by block: the block's words become symbols of the
benchmark's vocabulary, and only runs of known words at least as long as the
shortest phrase enter the index, since a phrase can occur nowhere else.  All
phrases are then searched backwards at once through the wavelet ranks, their
occurrences located by sampled suffix positions, and overlapping spans merged.

One narrow pass over the documents: nothing is shuffled.  The phrases are
collected in blocks of at most about ``block_bytes`` of benchmark text; a larger
benchmark takes one pass per block, chained, so that a worker holds one block.

Defined cases: null, empty and word-free texts (of documents or items) have no
words and hit nothing; ``items_sha256`` of no item is that of the empty string.
Items that repeat an item_id count once; a null item_id counts as the empty
string.  An empty benchmark hits nothing.  Repeated documents get equal rows.
Other columns of either table play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops as tx
from .common import Scratch, spread
from .fm_index import FMIndex

WINDOW = 10
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 1 << 19


@dataclass
class Phrases:
    """Distinct windows of some items, as symbols 2.. of their vocabulary."""

    words: np.ndarray  # sorted word hashes
    by_length: list[tuple[int, np.ndarray]]  # (number of the first phrase, phrases of one length)
    items: np.ndarray  # item numbers of all phrases
    item_ends: np.ndarray
    names: list[str]  # item ids as strings, sorted

    @property
    def shortest(self) -> int:
        return min((p.shape[1] for _, p in self.by_length), default=0)


def block_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, first): words of lower-cased texts."""
    low = tx.LOWER[data]
    s, e, first = tx.word_spans(low, offs, tx.ALNUM)
    return tx.word_hashes(low, s, e), s, e, first


def make_phrases(ids: list[str], texts: list[str], window: int) -> Phrases:
    names = sorted(set(ids))
    number = {x: i for i, x in enumerate(names)}
    raw = [t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64)
    h, _, _, first = block_words(np.frombuffer(b"".join(raw), dtype=np.uint8), offs)
    words, symbol = np.unique(h, return_inverse=True)
    symbol = symbol + 2
    count = np.diff(first)
    owner = np.array([number[x] for x in ids], dtype=np.int64)
    by_length, items, item_ends, total = [], [], [0], 0
    for length in sorted(set(np.minimum(count, window).tolist()) - {0}):
        these = np.flatnonzero(np.minimum(count, window) == length)
        row, at = spread(count[these] - length + 1)
        grid = symbol[(first[these][row] + at)[:, None] + np.arange(length)]
        phrases, which = np.unique(grid, axis=0, return_inverse=True)
        pairs = np.unique(np.stack((which.reshape(-1), owner[these][row]), 1), axis=0)
        by_length.append((total, phrases))
        items.append(pairs[:, 1])
        item_ends.extend((item_ends[-1] + np.searchsorted(pairs[:, 0], np.arange(len(phrases)), side="right")).tolist())
        total += len(phrases)
    return Phrases(words, by_length, np.concatenate(items) if items else np.zeros(0, np.int64), np.array(item_ends), names)


def find_phrases(phrases: Phrases, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, first word, words) of all occurrences in a block of texts."""
    none = np.zeros(0, dtype=np.int64)
    if not len(hashes) or not phrases.by_length:
        return none, none, none
    at = np.minimum(np.searchsorted(phrases.words, hashes), len(phrases.words) - 1)
    known = phrases.words[at] == hashes
    # maximal runs of known words within one text
    new = known.copy()
    new[1:] &= ~known[:-1]
    begins = first[:-1][first[:-1] < len(known)]
    new[begins] = known[begins]
    start = np.flatnonzero(new)
    inner = np.flatnonzero(known)
    length = np.diff(np.append(np.searchsorted(inner, start), len(inner)))
    long = length >= phrases.shortest
    start, length = start[long], length[long]
    if not len(start):
        return none, none, none
    row, place = spread(length)
    where = start[row] + place
    # a separator, 1, after each run
    symbols = np.ones(len(where) + len(start), dtype=np.int64)
    slot = np.arange(len(where)) + row
    symbols[slot] = at[where] + 2
    origin = np.full(len(symbols), -1, dtype=np.int64)
    origin[slot] = where
    index = FMIndex(symbols, len(phrases.words) + 2)
    found = []
    for base, grid in phrases.by_length:
        low, high = index.search(grid)
        which, k = spread(high - low)
        spot = origin[index.locate(low[which] + k)] if len(which) else none
        found.append((which + base, spot, np.full(len(which), grid.shape[1], dtype=np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _list_of_pairs(row: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["start", "end"])
    return pa.ListArray.from_arrays(pa.array(ends), pairs)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def scan(docs: DataFrame, shared, last: bool, window_bytes: int = SHARD_BYTES) -> DataFrame:
    """Merge one block's spans (in words) and items into docs (rest, text, spans, items).

    The pass of the last block makes the report in the same worker.
    """

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: Phrases = shared.value
        for batch in batches:
            for i, data, offs in tx.text_blocks(batch.column(1), window_bytes):
                h, _, _, first = block_words(data, offs)
                n = len(offs) - 1
                which, at, words = find_phrases(phrases, h, first)
                rows = batch.slice(i, n)
                old, had = rows.column(2), rows.column(3)
                flat = old.flatten()
                owner, _ = spread(np.diff(old.offsets.to_numpy()))
                start = np.concatenate((at, first[owner] + flat.field("start").to_numpy()))
                end = np.concatenate((at + words, first[owner] + flat.field("end").to_numpy()))
                hit = np.zeros(len(h) + 1, dtype=np.int64)
                np.add.at(hit, start, 1)
                np.add.at(hit, end, -1)
                hit = np.cumsum(hit)[:-1] > 0
                a, b = tx.runs(hit)
                # a run may go on from the end of one text to the next one's start
                text = np.searchsorted(first, a, side="right") - 1
                last = np.searchsorted(first, b - 1, side="right") - 1
                k, j = spread(last - text + 1)
                text_of = text[k] + j
                a, b = np.maximum(a[k], first[text_of]), np.minimum(b[k], first[text_of + 1])
                some = a < b
                text_of, a, b = text_of[some], a[some], b[some]
                doc = np.searchsorted(first, at, side="right") - 1
                row, k = spread(np.diff(phrases.item_ends)[which])
                pairs = np.unique(np.stack((doc[row], phrases.items[phrases.item_ends[which][row] + k]), 1), axis=0)
                names = had.to_pylist()
                for d, item in pairs.tolist():
                    names[d] = names[d] + [phrases.names[item]]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), _list_of_pairs(text_of, a - first[text_of], b - first[text_of], n), pa.array([sorted(set(x)) for x in names], pa.list_(pa.string()))],
                    names=["rest", "text", "spans", "items"],
                )

    if last:
        return docs.mapInArrow(lambda batches: reported(merged(batches)), report_schema(docs))
    schema = T.StructType([docs.schema["rest"], T.StructField("text", T.StringType()), T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(T.StringType()))])
    return docs.mapInArrow(merged, schema)


def reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, digests and clean texts of scanned batches."""
    for batch in batches:
        for i, data, offs in tx.text_blocks(batch.column(1)):
            _, s, e, first = block_words(data, offs)
            rows = batch.slice(i, len(offs) - 1)
            spans, items = rows.column(2).to_pylist(), rows.column(3).to_pylist()
            hit, clean = [], []
            for d, found in enumerate(spans):
                text = data[offs[d] : offs[d + 1]].tobytes()
                hit.append(sum(x["end"] - x["start"] for x in found))
                if found:
                    cut, parts = 0, []
                    for x in found:
                        parts.append(text[cut : s[first[d] + x["start"]] - offs[d]])
                        cut = e[first[d] + x["end"] - 1] - offs[d]
                    text = b"".join([*parts, text[cut:]])
                clean.append(text)
            digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.diff(first).astype(np.int64)), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(digest), pa.array([x > 0 for x in hit]), rows.column(2), rows.column(3), pa.array(clean, pa.binary()).cast(pa.string())],
                names=["rest", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "items", "clean_text"],
            )


def report_schema(docs: DataFrame) -> T.StructType:
    return T.StructType([
        docs.schema["rest"], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()), T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("clean_text", T.StringType()),
    ])


def _found(docs: DataFrame, rest: Column, text: Column, benchmark: DataFrame, item_col: str, item_text_col: str, window: int, block_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = docs.select(rest.alias("rest"), F.coalesce(text, F.lit("")).alias("text"), F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    scratch = Scratch(spark, "contamination")
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).toArrow()
        phrases = make_phrases(block.column("item").to_pylist(), block.column("text").to_pylist(), window)
        shared = spark.sparkContext.broadcast(phrases)
        out = scan(out, shared, b == blocks - 1)
        if b < blocks - 1:
            # a pass of its own: an executor holds one block at a time
            out = scratch.table(out, f"pass-{b}")
            shared.unpersist()
            if b:
                scratch.drop(f"pass-{b - 1}")
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items, clean_text.

    ``spans`` are the merged hits in word numbers; ``clean_text`` is the text
    without them, each cut from its first word's start to its last word's end.
    """
    out = _found(docs, F.col(id_col), F.col(text_col), benchmark, item_col, item_text_col, window, block_bytes)
    return out.withColumnRenamed("rest", id_col)


def cut_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs, all columns, with the clean text; documents made of nothing but hits go."""
    rest = F.struct(*[docs[c] for c in docs.columns])
    out = _found(docs, rest, F.col(text_col), benchmark, item_col, item_text_col, window, block_bytes).where("n_hit = 0 or n_hit < n_words")
    clean = F.when(F.col("contaminated"), F.col("clean_text")).otherwise(F.col("rest").getField(text_col))
    return out.select(*[clean.alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns])
