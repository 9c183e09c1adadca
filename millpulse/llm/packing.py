"""Operator 3: best-fit packing of tokenized documents, by hierarchical residual packing.

Each task tokenizes its documents and cuts those longer than a sequence.  The
pieces, as (number, length), are dealt evenly to nodes of a bounded size and each
node packs its items best-fit, longest first.  Bins that are nearly full are
sequences.  Underfull bins go up a tree as single items: a round deals them to
fewer nodes and packs each node best-fit again; a bin's pieces keep their order
and gain the bin's offset in its new bin.  The tree ends at one node, or at nodes
of ``node_bins`` bins where there are more underfull bins than one task should
hold (a node that large loses next to nothing).  Token ids never move.

Defined cases: null text is empty; an empty text is its end token alone.
Repeated rows are packed each on its own.  A null id is kept as it is.  An
empty table gives no rows.  Only the id and the text column are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops as tx
from .byte_bpe import load
from .common import Scratch, binary, groups, spread

CAPACITY = 1024
END = 2
NODE_BINS = 10_000
FAN_IN = 8
#: Free places of a bin that counts as nearly full: capacity / 256.
NEARLY = 256


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the use of each bin: longest first, into the fullest bin that takes it."""
    bins, offset = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    used: list[int] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0  # bit f: some bin has f places free
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = open_ >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                open_ ^= 1 << free
        else:
            b, free = len(used), capacity
            used.append(0)
        bins[i], offset[i] = b, used[b]
        used[b] += size
        free -= size
        if free:
            if not by_free[free]:
                open_ |= 1 << free
            by_free[free].append(b)
    return bins, offset, np.array(used, dtype=np.int64)


def cut_pieces(tokens: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length): whole sequences from the end, the first piece takes the rest."""
    many = -(-tokens // capacity)
    doc, piece = spread(many)
    rest = tokens - (many - 1) * capacity
    start = np.where(piece > 0, rest[doc] + (piece - 1) * capacity, 0)
    return doc, piece, start, np.where(piece > 0, capacity, rest[doc])


def _pieces(docs: DataFrame, path: str, capacity: int, end: int, with_ids: bool) -> DataFrame:
    """Pieces of the documents, numbered by task and place (``bin``)."""
    names = ["id", "piece", "start", "length", "ids_crc32", "bin", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i, data, offs in tx.text_blocks(batch.column(1)):
                ids, ends = encoder.encode_column(data, offs)
                # each document's end token after its ids
                n = len(offs) - 1
                closed = np.insert(ids.astype("<u4"), ends[1:], end)
                ends = ends + np.arange(n + 1)
                doc, piece, start, length = cut_pieces(np.diff(ends), capacity)
                begin = ends[doc] + start
                raw = memoryview(closed.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
                row = [batch.column(0).take(pa.array(doc + i)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(number + np.arange(len(doc)))]
                if with_ids:
                    row.append(binary(closed, np.concatenate(([0], np.cumsum(length)))))
                number += len(doc)
                yield pa.RecordBatch.from_arrays(row, names=names)
        encoder.clear()  # the worker lives on

    fields = [docs.schema["id"], T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in names[2:6]), *([T.StructField("ids", T.BinaryType())] if with_ids else [])]
    return docs.select("id", "text").mapInArrow(run, T.StructType(fields))


def _merge_round(bins: DataFrame, nodes: int, capacity: int) -> DataFrame:
    """(bin, into, shift, used): best fit of the bins of each node; a new bin has the name of its first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node in groups(batches, ["node"]):
            name, size = node.column("bin").to_numpy(), node.column("used").to_numpy()
            into, shift, used = best_fit(size, capacity)
            head = np.zeros(len(used), dtype=np.int64)
            head[into[shift == 0]] = name[shift == 0]
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(head[into]), pa.array(shift), pa.array(used[into])], names=["bin", "into", "shift", "used"])

    placed = bins.select("bin", "used", F.pmod(F.xxhash64("bin"), F.lit(nodes)).alias("node"))
    return placed.repartition("node").sortWithinPartitions("node").mapInArrow(run, "bin long, into long, shift long, used long")


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = False, node_bins: int = NODE_BINS, fan_in: int = FAN_IN) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and the ids, little-endian, if asked for)."""
    scratch = Scratch(docs.sparkSession, "packing")
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = scratch.table(_pieces(docs, path, capacity, end, with_ids), "pieces").withColumn("offset", F.lit(0).cast("long"))
    full = capacity - capacity // NEARLY
    rest = out.where(F.col("length") < full).select("bin", F.col("length").alias("used"))
    rounds, before = 0, None
    while (many := rest.count()) > 1:
        nodes = -(-many // node_bins)
        if before is not None:
            nodes = max(nodes, -(-before // fan_in))
        if nodes == before:
            break
        moved = scratch.table(_merge_round(rest, nodes, capacity), f"round-{rounds}")
        step = moved.where("bin <> into").select(F.col("bin").alias("moved"), "into", "shift")
        out = out.join(step, F.col("bin") == F.col("moved"), "left").withColumn("bin", F.coalesce("into", "bin")).withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0))).drop("moved", "into", "shift")
        rest = moved.where((F.col("bin") == F.col("into")) & (F.col("used") < full)).select("bin", "used")
        rounds, before = rounds + 1, nodes
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset", *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from pieces packed ``with_ids``."""
    one = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return one.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
