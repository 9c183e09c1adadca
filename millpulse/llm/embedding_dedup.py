"""Operator 4: near-duplicate embeddings by one small-world graph per shard.

Equal vectors are one class.  The classes are dealt to shards by hash; each shard
builds a hierarchical navigable small-world graph of its own (``hnsw``), stored
in the shared folder.  Every class queries every shard: queries stream through
tasks that hold one shard's graph each, so a task's memory is one shard and one
batch; a shard has at most as many tasks as there are shards, so that graphs are
sent no more often than queries.  A beam that ends full of hits is widened for its
query.  Pairs are verified by the cosine in double precision; a task returns edges
that connect what its links connect, not the pairs.  The links of a class are then
counted exactly, block against block of its component, so that a link found from
one end counts at both.

Audits compare the links found with brute force over all shards, for a sample of
the classes and for probes: copies of them turned by a random direction to a
cosine just above the threshold.  Each probe has a link, the hardest to find, so
an audit has evidence where the table holds no link.  Recall is a mean over
queries, and those with few links and those with many have to reach ``recall``
each; until then the beam is doubled.

Defined cases: null vectors, empty ones, zero vectors and vectors with null or
non-finite components link with nothing.  Vectors of different dimensions are
not compared.  Rows with the same vector are linked with each other.  A null id
takes part; it names a component only where all ids of it are null.  Empty table:
no rows.  Only the id and the vector column are read (labels play no part).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, binary_values, column, groups
from .graph import components
from .hnsw import Hnsw, levels, unit

COSINE = 0.95
SHARDS = 8
SHARD_ROWS = 200_000
QUERY_ROWS = 20_000
BEAM = 32
AUDIT = 256
RECALL = 0.99
#: Audited queries with at most so many links are judged apart from the others.
FEW = 10
#: A probe's cosine with its origin lies this part of the way from the threshold to 1.
NEAR = 0.02
#: Probes are numbered from here on.
PROBE = 1 << 62
#: Bytes of a stored graph; a component is counted in blocks of so many classes.
GRAPH_BYTES = 1 << 28
BLOCK_ROWS = 4096
#: Pairs of a slice of queries with a whole shard (but for 8 queries), and numbers of the vectors verified at a time.
PAIRS = 1 << 22
VERIFIED = 1 << 20
#: Room for single precision in the search; the verification decides.
SLACK = 1e-4


def _pack(index: Hnsw, nid: np.ndarray, weight: np.ndarray, vectors: np.ndarray) -> bytes:
    head = np.array([len(nid), vectors.shape[1], len(index.sizes), *(x for layer in index.links for x in layer.shape)], dtype=np.int64)
    return b"".join([np.int64(len(head)).tobytes(), head.tobytes(), nid.astype(np.int64).tobytes(), weight.astype(np.int64).tobytes(), vectors.astype(np.float64).tobytes(), *(layer.tobytes() for layer in index.links)])


def _unpack(raw: bytes) -> tuple[Hnsw, np.ndarray, np.ndarray, np.ndarray]:
    at = 8
    head = np.frombuffer(raw, np.int64, int(np.frombuffer(raw, np.int64, 1)[0]), at)
    at += head.nbytes

    def take(dtype, *shape):
        nonlocal at
        out = np.frombuffer(raw, dtype, int(np.prod(shape)), at).reshape(shape)
        at += out.nbytes
        return out

    n, dim, layers = (int(x) for x in head[:3])
    nid, weight, vectors = take(np.int64, n), take(np.int64, n), take(np.float64, n, dim)
    links = [take(np.int32, *head[3 + 2 * x : 5 + 2 * x]) for x in range(layers)]
    return Hnsw.stored(vectors, [len(x) for x in links], links), nid, weight, vectors


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of batches with one value of a sorted key."""
    for batch in batches:
        if batch.num_rows:
            v = batch.column(batch.schema.get_field_index(key)).to_numpy()
            cuts = [0, *(np.flatnonzero(v[1:] != v[:-1]) + 1).tolist(), len(v)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield int(v[a]), batch.slice(a, b - a)


def build_shards(classes: DataFrame) -> DataFrame:
    """(shard, index): a graph for each shard of (shard, nid, n, vector)."""

    def finish(shard: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        nid, weight = t.column("nid").to_numpy(), t.column("n").to_numpy()
        values, _ = binary_values(t.column("vector"), np.float64)
        vectors = unit(values.reshape(len(nid), -1))
        # levels by a hash of the class: the graph does not depend on the order of rows
        draw = ((nid.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0x5851F42D4C957F2D)
        draw = (draw ^ (draw >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        level = levels((draw >> np.uint64(11)).astype(np.float64) / 2.0**53)
        order = np.lexsort((draw, -level))
        index = Hnsw(vectors[order], level[order])
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([_pack(index, nid[order], weight[order], vectors[order])], pa.binary())], names=["shard", "index"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for shard, part in _runs(batches, "shard"):
            if held and shard != now:
                yield finish(now, held)
                held = []
            now = shard
            held.append(part)
        if held:
            yield finish(now, held)

    return classes.select("shard", "nid", "n", "vector").repartition("shard").sortWithinPartitions("shard", "nid").mapInArrow(run, "shard long, index binary")


def query_shards(index: DataFrame, queries: DataFrame, shards: int, salts: int, cosine: float, beam: int, exact: bool = False) -> DataFrame:
    """(u, v): edges that connect the classes linked in a cell.

    ``exact`` (for audits) returns (u, c, e) instead: per query and shard the weight c
    of the links found, and e of all links by brute force.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, graph = None, None
        for cell, part in _runs(batches, "cell"):
            if cell != now:  # a cell's first row is its graph; an empty shard has none
                now, graph = cell, None
                if part.column("nid")[0].as_py() < 0:
                    graph = _unpack(part.column("body")[0].as_py())
                    part = part.slice(1)
            if graph is None or not part.num_rows:
                continue
            hnsw, nid, weight, vectors = graph
            qid = part.column("nid").to_numpy()
            values, _ = binary_values(part.column("body"), np.float64)
            q = unit(values.reshape(len(qid), -1))
            count, x, y = graph_links(hnsw, nid, weight, vectors, qid, q, cosine, beam)
            if not exact:
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["u", "v"])
                continue
            every = np.zeros(len(qid), dtype=np.int64)
            for s in range(0, len(qid), 16):
                a, b = np.nonzero(q[s : s + 16] @ vectors.T >= cosine - SLACK)
                for a, b in _verified(a + s, b, nid, vectors, qid, q, cosine):
                    np.add.at(every, a, weight[b])
            yield pa.RecordBatch.from_arrays([pa.array(qid), pa.array(count), pa.array(every)], names=["u", "c", "e"])

    cell = F.col("shard") * salts + F.col("salt")
    graphs = index.select("shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(-1).cast("long").alias("nid"), F.col("index").alias("body"))
    asked = queries.withColumn("salt", F.pmod(F.xxhash64("nid", F.lit(1)), F.lit(salts)).cast("int")).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), "salt", "nid", F.col("vector").alias("body"))
    both = graphs.unionByName(asked).select(cell.alias("cell"), "nid", "body")
    return both.repartition(shards * salts, "cell").sortWithinPartitions("cell", "nid").mapInArrow(run, "u long, c long, e long" if exact else "u long, v long")


def _verified(a: np.ndarray, b: np.ndarray, nid: np.ndarray, vectors: np.ndarray, qid: np.ndarray, q: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs (query, node) that reach the cosine in double precision, some at a time."""
    step = max(1, VERIFIED // q.shape[1])
    for s in range(0, len(a), step):
        x, y = a[s : s + step], b[s : s + step]
        ok = (np.einsum("ij,ij->i", q[x], vectors[y]) >= cosine) & (qid[x] != nid[y])
        yield x[ok], y[ok]


def graph_links(hnsw: Hnsw, nid: np.ndarray, weight: np.ndarray, vectors: np.ndarray, qid: np.ndarray, q: np.ndarray, cosine: float, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's weight of links, and edges (u, v) that connect what the links connect.

    Queries come in slices of so few that all their pairs with the shard have room;
    a slice leaves counts and labels only, so memory does not grow with a group.
    """
    count = np.zeros(len(qid), dtype=np.int64)
    names, place = np.unique(np.concatenate((qid, nid)), return_inverse=True)
    mine, theirs = place[: len(qid)], place[len(qid) :]
    label = np.arange(len(names))
    step = max(8, min(256, PAIRS // max(1, len(nid))))
    for s in range(0, len(qid), step):
        a, b = hnsw.within(q[s : s + step], cosine - SLACK, beam)
        for x, y in _verified(a + s, b, nid, vectors, qid, q, cosine):
            np.add.at(count, x, weight[y])
            _connect(label, mine[x], theirs[y])
    moved = np.flatnonzero(label != np.arange(len(names)))
    return count, names[moved], names[label[moved]]


def _connect(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of the pairs (a, b); ``label`` names each place's class by its least member."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def probes(sample: DataFrame, cosine: float) -> DataFrame:
    """Each class of the sample turned by a direction drawn from its number; vectors of one entry stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nid = column(batch, "nid")
            q = unit(binary_values(batch.column(batch.schema.get_field_index("vector")), np.float64)[0].reshape(len(nid), -1))
            if q.shape[1] > 1:
                turn = np.stack([np.random.default_rng(int(i)).normal(size=q.shape[1]) for i in nid])
                turn = unit(turn - np.einsum("ij,ij->i", turn, q)[:, None] * q)
                c = cosine + (1 - cosine) * NEAR
                q = c * q + np.sqrt(1 - c * c) * turn
            yield pa.RecordBatch.from_arrays([pa.array(nid + PROBE), batch.column(batch.schema.get_field_index("n")), pa.array([x.tobytes() for x in q], pa.binary())], names=["nid", "n", "vector"])

    return sample.select("nid", "n", "vector").mapInArrow(run, "nid long, n long, vector binary")


def _recall(audit: DataFrame) -> float:
    """The lower of the mean recalls of queries with few links and with many; 1 without any."""
    each = audit.groupBy("u").agg(F.sum("c").alias("c"), F.sum("e").alias("e")).where("e > 0")
    means = each.groupBy(F.col("e") <= FEW).agg(F.avg(F.col("c") / F.col("e"))).collect()
    return min((r[1] for r in means), default=1.0)


def count_links(members: DataFrame, cosine: float) -> DataFrame:
    """(u, c): the weight of each class's links to others of its component.

    ``members``: (root, nid, n, vector).  A component's classes are dealt to blocks,
    and a task compares two blocks of one component, so its memory is two blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["root", "i", "j"]):
            nid, n, first = (t.column(x).to_numpy() for x in ("nid", "n", "first"))
            v = unit(binary_values(t.column("vector"), np.float64)[0].reshape(len(nid), -1))
            one = len(np.unique(first)) == 1 and t.column("i")[0].as_py() == t.column("j")[0].as_py()
            left, right = (np.arange(len(nid)),) * 2 if one else (np.flatnonzero(first), np.flatnonzero(~first))
            count = np.zeros(len(nid), dtype=np.int64)
            for s in range(0, len(left), 512):
                a = left[s : s + 512]
                near = v[a] @ v[right].T
                # as in the search, pairs at the threshold are decided by one sum of products
                for x, y in np.argwhere(np.abs(near - cosine) < 1e-9).tolist():
                    near[x, y] = np.einsum("i,i->", v[a[x]], v[right[y]])
                hit = (near >= cosine) & (nid[a][:, None] != nid[right])
                count[a] += hit @ n[right]
                if not one:
                    count[right] += n[a] @ hit
            yield pa.RecordBatch.from_arrays([pa.array(nid), pa.array(count)], names=["u", "c"])

    blocks = members.groupBy("root").agg(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).cast("int").alias("blocks"))
    dealt = members.join(blocks, "root").withColumn("own", F.pmod(F.xxhash64("nid", F.lit(3)), F.col("blocks")).cast("int"))
    meets = dealt.select("root", "own", "nid", "n", "vector", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = meets.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("first"), "nid", "n", "vector")
    counted = cells.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(run, "u long, c long")
    return counted.groupBy("u").agg(F.sum("c").alias("c"))


def _binary_vectors(df: DataFrame) -> DataFrame:
    """(nid, n, vector as bytes of doubles) of (nid, n, vector as array)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(2)
            flat = np.ascontiguousarray(col.flatten().to_numpy(), dtype=np.float64)
            ends = (col.offsets.to_numpy().astype(np.int64) - col.offsets[0].as_py()) * 8
            raw = pa.Array.from_buffers(pa.binary(), len(col), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), raw], names=["nid", "n", "vector"])

    return df.select("nid", "n", F.col("vector").cast("array<double>").alias("vector")).mapInArrow(run, "nid long, n long, vector binary")


def link_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, shards: int = SHARDS, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, beam: int = BEAM, recall: float = RECALL) -> DataFrame:
    """Per row: id, n_links, component_id, kept."""
    scratch = Scratch(rows.sparkSession, "vectors")
    rows = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.coalesce((F.size("vector") > 0) & ~bad & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("key", F.when(good, F.transform("vector", lambda x: x + 0.0)))  # -0.0 is 0.0
    classes = rows.where("key is not null").groupBy(F.col("key").alias("vector")).agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = scratch.table(classes.withColumn("nid", F.monotonically_increasing_id()), "classes")
    dims = [(r[0], r[1]) for r in classes.groupBy(F.size("vector")).count().collect()]
    links, vectors = None, None
    for dim, many in sorted(dims):
        mine = scratch.table(_binary_vectors(classes.where(F.size("vector") == dim)), f"vectors-{dim}")
        room = max(1, min(shard_rows, GRAPH_BYTES // (8 * dim + 300)))
        parts = max(shards, -(-many // room))
        salts = min(parts, max(1, -(-many // query_rows)))
        index = scratch.table(build_shards(mine.withColumn("shard", F.pmod(F.xxhash64("nid"), F.lit(parts)))), f"index-{dim}")
        sample = scratch.table(mine.orderBy(F.xxhash64("nid", F.lit(2))).limit(AUDIT), f"audit-{dim}")
        asked = scratch.table(sample.union(probes(sample, cosine)), f"asked-{dim}")
        width = beam
        while _recall(query_shards(index, asked, parts, 1, cosine, width, exact=True)) < recall and width < room:
            width *= 2
        edges = scratch.table(query_shards(index, mine, parts, salts, cosine, width), f"links-{dim}")
        links, vectors = (edges, mine) if links is None else (links.union(edges), vectors.union(mine))
    if links is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = scratch.table(components(links, scratch, "components").distinct(), "found")
    counts = count_links(vectors.join(found, F.col("nid") == F.col("node")).select("root", "nid", "n", "vector"), cosine)
    named = classes.join(found, F.col("nid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "nid"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").join(counts, F.col("nid") == F.col("u"), "left").select(F.col("vector").alias("key"), "component_id", (F.coalesce("c", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = rows.select("id", "key").join(named, "key", "left").withColumn("component_id", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
