"""Operator 2: near-duplicate documents by MinHash with tensored banding.

Method
  1. Each document becomes its set of distinct w-word shingles.  Documents with
     equal sets are one class; everything below works on classes, so a group of
     exact copies costs one class however large it is.
  2. Tensored banding: two collections A and B of ``m`` sub-keys, each of ``r``
     min-hashes.  Table (i, j) has the key (A_i, B_j): ``m*m`` tables of
     ``2*r`` rows need ``2*m*r`` min-hashes, not ``2*m*m*r``.  Two sets of
     similarity s meet in some table with probability (1-(1-s^r)^m)^2:
     0.99985 at 0.85 for m=10, r=3.
  3. Two classes meet in a table only if they share an A and a B sub-key.  Each
     class's sub-keys are counted first and only shared ones are combined, which
     loses no meeting and saves the m*m keys of documents without any near copy.
  4. Classes that meet form candidate clusters (components of the stars around
     each key's least class).
  5. Inside a cluster all pairs are compared on their full shingle sets.  Large
     clusters are cut into blocks and every pair of blocks is a task of its own;
     a task returns a spanning forest of the links it found, never the pairs.
     So every candidate pair, and every further pair of the cluster, is decided
     exactly, and no group meets in one task.
  6. Components of the links give the result.

Defined cases: null or blank text and text without words have the empty set,
link with nothing and are kept.  Fewer than w words: the whole sequence is the
one shingle.  Rows with a null id take part; they never name a component unless
all its ids are null (then ``component_id`` is null and they are kept); ``first``
marks exactly one document of each group, also among equal ids.
Repeated rows (same id and text) get the same answer.  Only the id and the text
column are read; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import textops as tx
from .common import Scratch, binary, binary_values, groups, shuffled, spread
from .graph import components

W = 5
TABLES = 10  # m: sub-keys in each collection
ROWS = 3  # r: min-hashes in a sub-key
BLOCK_SETS = 1024
BLOCK_BYTES = 8 << 20

_U = np.uint64


def shingles(data: np.ndarray, offs: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a block's texts, repeats included, and each text's offset into them."""
    data = tx.LOWER[data]
    s, e, first = tx.word_spans(data, offs, tx.NOT_SPACE)
    words = tx.sequence(tx.word_hashes(data, s, e))
    n = np.diff(first)
    count = np.where(n >= w, n - w + 1, np.minimum(n, 1))
    row, at = spread(count)
    begin = first[:-1][row] + at
    return words.slices(begin, begin + np.minimum(n, w)[row]), np.concatenate(([0], np.cumsum(count)))


def distinct_sets(h: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sorted distinct hashes, and the new offsets."""
    parts = [np.unique(h[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return (np.concatenate(parts) if parts else h), np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)


def hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n pairs (xor value, odd factor), the same everywhere."""
    seeds = tx.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * _U(0x632BE59BD9B4E019))
    return seeds[:n], seeds[n:] | _U(1)


def sub_keys(h: np.ndarray, ends: np.ndarray, m: int, r: int) -> np.ndarray:
    """(texts, 2*m) sub-keys of non-empty sets: collection A, then B."""
    xor, odd = hash_family(2 * m * r)
    out = np.zeros((len(ends) - 1, 2 * m), dtype=np.uint64)
    at = ends[:-1]
    for p in range(2 * m):
        key = np.full(len(at), _U(p + 1) * _U(0x2545F4914F6CDD1D & 0xFFFFFFFFFFFF))
        for q in range(p * r, p * r + r):
            least = np.minimum.reduceat((h ^ xor[q]) * odd[q], at)
            key = tx.mix(key ^ least)
        out[:, p] = key
    return out


_SIGNED = T.StructType([T.StructField("h", T.LongType()), T.StructField("n", T.LongType()), T.StructField("c1", T.LongType()), T.StructField("c2", T.LongType()), T.StructField("parts", T.ArrayType(T.LongType()))])


def signatures(docs: DataFrame, w: int, m: int, r: int) -> DataFrame:
    """Per document: id, text hash h, set size n, set hash (c1, c2), sub-keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for i, data, offs in tx.text_blocks(texts):
                h, ends = distinct_sets(*shingles(data, offs, w))
                n = np.diff(ends)
                full = np.flatnonzero(n)
                c1, c2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                keys = np.zeros((0, 2 * m), np.uint64)
                if len(full):
                    at = np.append(ends[:-1][full], len(h))
                    c1[full] = np.add.reduceat(tx.mix(h ^ _U(0x5851F42D4C957F2D)), at[:-1])
                    c2[full] = np.add.reduceat(tx.mix(h ^ _U(0x14057B7EF767814F)), at[:-1])
                    keys = sub_keys(h, at, m, r)
                width = np.where(n > 0, 2 * m, 0)
                parts = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(width))), pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
                rows = batch.slice(i, len(n))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(n, pa.int64()), pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)), parts], names=["id", "h", "n", "c1", "c2", "parts"])

    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType), *_SIGNED.fields])
    return docs.select("id", "h", "text").mapInArrow(run, schema)


def set_rows(docs: DataFrame, w: int) -> DataFrame:
    """(cluster, cells, nid, shingles): the sorted distinct shingle hashes of rows with cluster, cells, nid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, offs in tx.text_blocks(batch.column(3)):
                h, ends = distinct_sets(*shingles(data, offs, w))
                rows = batch.slice(i, len(ends) - 1)
                yield pa.RecordBatch.from_arrays([*rows.columns[:3], binary(h, ends)], names=["cluster", "blocks", "nid", "shingles"])

    return docs.select("cluster", "blocks", "nid", "text").mapInArrow(run, "cluster long, blocks int, nid long, shingles binary")


def overlaps(values: np.ndarray, ends: np.ndarray, most: int = 1 << 23) -> np.ndarray:
    """(n, n) sizes of the intersections of n sets of distinct hashes."""
    n = len(ends) - 1
    owner = np.repeat(np.arange(n), np.diff(ends))
    order = np.argsort(values, kind="stable")
    v, owner = values[order], owner[order]
    new = np.concatenate(([True], v[1:] != v[:-1])) if len(v) else np.zeros(0, bool)
    ident = np.cumsum(new) - 1
    shared = np.bincount(ident, minlength=1)[ident] > 1 if len(v) else np.zeros(0, bool)
    owner, ident = owner[shared], ident[shared]
    out = np.zeros((n, n), dtype=np.float32)
    if len(ident):
        ident = np.cumsum(np.concatenate(([False], ident[1:] != ident[:-1])))
        step = max(64, most // n)
        for a in range(0, int(ident[-1]) + 1, step):
            lo, hi = np.searchsorted(ident, (a, a + step))
            part = np.zeros((n, min(step, int(ident[-1]) + 1 - a)), dtype=np.float32)
            part[owner[lo:hi], ident[lo:hi] - a] = 1
            out += part @ part.T
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the given links."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[p] = q
            out.append((x, y))
    return out


def set_links(sizes: np.ndarray, common: np.ndarray, part: int, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with whole * intersection >= part * union."""
    union = sizes[:, None] + sizes[None, :] - common
    return np.nonzero(np.triu((whole * common >= part * union) & (common > 0), 1))


def compare_cells(cells: DataFrame, part: int, whole: int) -> DataFrame:
    """Spanning links (u, v) of every cell of (cluster, i, j, nid, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in groups(batches, ["cluster", "i", "j"]):
            nid, keep = np.unique(cell.column("nid").to_numpy(), return_index=True)  # repeated rows once
            if len(nid) < 2:
                continue
            values, ends = binary_values(cell.column("shingles").take(pa.array(keep)), np.uint64)
            sizes = np.diff(ends).astype(np.float64)
            links = forest(len(nid), *set_links(sizes, overlaps(values, ends).astype(np.float64), part, whole))
            if links:
                x, y = np.array(links).T
                yield pa.RecordBatch.from_arrays([pa.array(nid[x]), pa.array(nid[y])], names=["u", "v"])

    return cells.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(run, "u long, v long")


def candidate_clusters(classes: DataFrame, m: int, scratch: Scratch) -> DataFrame:
    """(nid, cluster) of classes (nid, parts) that meet another one in a table."""
    one = classes.where("n > 0").select("nid", F.posexplode("parts").alias("p", "v"))
    # v holds its place in its hash; "side" tells A from B
    one = one.select("nid", "v", (F.col("p") >= m).alias("side"))
    shared = one.groupBy("v").agg(F.count("*").alias("c")).where("c > 1").select("v")
    live = one.join(shared, "v", "left_semi")
    sides = live.groupBy("nid").agg(F.collect_list(F.when(~F.col("side"), F.col("v"))).alias("a"), F.collect_list(F.when(F.col("side"), F.col("v"))).alias("b")).where("size(a) > 0 and size(b) > 0")
    sides = scratch.table(sides, "sides")
    keys = sides.select("nid", F.explode("a").alias("x"), "b").select("nid", "x", F.explode("b").alias("y")).select("nid", F.xxhash64("x", "y").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("nid").alias("hub"), F.count("*").alias("c")).where("c > 1").select("key", "hub")
    stars = keys.join(hubs, "key").where("nid <> hub").select(F.col("nid").alias("u"), F.col("hub").alias("v"))
    found = components(stars, scratch, "clusters")
    return found.select(F.col("node").alias("nid"), F.col("root").alias("cluster"))


def _row() -> Column:
    """A document's place among the copies of its set: rows with a null id come last."""
    return F.struct(F.col("id").isNull().alias("unnamed"), "id", "h")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", w: int = W, part: int = 85, whole: int = 100, m: int = TABLES, r: int = ROWS, block_sets: int = BLOCK_SETS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: id, h (hash of the text), n_shingles, component_id, kept, first (the row of its group that stays).

    Links are pairs with ``whole * |x & y| >= part * |x | y|``.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    signed = scratch.table(signatures(docs, w, m, r), "signatures")
    classes = signed.where("n > 0").groupBy("c1", "c2", "n").agg(F.min("id").alias("least"), F.min(_row()).alias("rep"), F.first("parts").alias("parts"))
    classes = scratch.table(classes.withColumn("nid", F.monotonically_increasing_id()), "classes")
    clusters = scratch.table(candidate_clusters(classes, m, scratch), "candidates")
    live = clusters.join(classes.select("nid", "n", "rep.id", "rep.h"), "nid")
    sizes = live.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / block_sets), F.ceil(F.sum("n") * 8 / block_bytes)).cast("int").alias("blocks"))
    live = scratch.table(live.join(sizes, "cluster").select("cluster", "blocks", "nid", F.col("id").alias("rid"), F.col("h").alias("rh")), "live")
    wanted = docs.join(shuffled(live), docs["id"].eqNullSafe(live["rid"]) & (docs["h"] == live["rh"]))
    sets = set_rows(wanted, w)
    own = F.pmod(F.xxhash64("nid"), F.col("blocks").cast("long")).cast("int")
    cells = sets.select("cluster", "nid", "shingles", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "nid", "shingles")
    found = components(compare_cells(cells, part, whole), scratch, "links")
    named = classes.select("nid", "c1", "c2", "n", "least", "rep").join(found, F.col("nid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "nid"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"), F.min("rep").alias("first"))
    named = named.join(least, "root").select("c1", "c2", "n", "component_id", "first")
    out = signed.join(named, ["c1", "c2", "n"], "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id_col), "h", F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), F.coalesce(_row() == F.col("first"), F.lit(True)).alias("first"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs, all columns, of which one stays of each group of near copies.

    Documents without words are in no group.  Of repeated rows one stays.
    """
    scratch = Scratch(docs.sparkSession, "keep")
    stays = scratch.table(near_duplicates(docs, id_col, text_col, **how).where("first").select(F.col(id_col).alias("sid"), F.col("h").alias("sh"), (F.col("n_shingles") > 0).alias("words")).distinct(), "stays")
    row = F.struct(*[docs[c] for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"))
    out = keyed.join(shuffled(stays), keyed["id"].eqNullSafe(stays["sid"]) & (keyed["h"] == stays["sh"]))
    copy = F.row_number().over(Window.partitionBy("id", "h").orderBy(F.lit(0)))
    return out.withColumn("copy", copy).where("copy = 1 or not words").select("row.*")
