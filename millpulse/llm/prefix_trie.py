"""Operator 12: the trie of conversation prefixes, by balanced parentheses a shard.

A turn is the 128-bit hash of its role and text; a conversation's path is the row of
its turns' hashes.  Conversations of one path are one class.  Classes are range
partitioned by path: a shard is a stretch of the sorted paths and holds their trie
as balanced parentheses (``parentheses``).  Longest common prefixes of neighbours
tell what closes and opens; ``find_close`` delimits each subtree; ranks of leaf pairs
count its leaves, cumulative arrays its members and savings.

Only the nodes on a shard's first and last path (its spines) can go on in other
shards.  All others are final.  A spine goes up as one item with what hangs below
its nodes; items are sorted and sharded again, some shards' spines to a task, until
one task holds the last few.  A level's items are two for each shard below.

A class's ids are joined in range-partitioned, sorted pieces, and its digest streams
over the pieces, so a task holds a piece and not the class.

Defined cases: rows without conv_id belong to no conversation.  Turns are in order of
turn (null first), role, then the turn's hash; repeated rows are turns of their
own.  Null role or text is empty.  A sequence without turns is a member of the root
only.  No sequences: no nodes, not even a root.  Only the named columns are read.
A path is one value of 16 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, binary_values, spread
from .parentheses import Parentheses, range_minima, range_sums

TURN = 16
#: Turns of distinct paths in a shard, about.
SHARD_TURNS = 200_000
NOBODY = np.iinfo(np.int64).max
EMPTY = hashlib.sha256(b"").hexdigest()

#: What hangs at a node of an item: members, smallest one, digest of those that end here, and of subtrees already final: children, leaves, savings.
AT = "depth int, n long, lo long, ends string, children long, leaves long, saved long"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, key string, parent_key string"
ITEM = f"path binary, sizes binary, at array<struct<{AT}>>, keys array<string>"
OUT = f"shard long, node struct<{NODE}>, item struct<{ITEM}>"


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (h, n): hex hash, code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    h = F.md5(F.concat(F.length(role), F.lit(":"), role, text))
    turn = F.struct(conversations["turn"].alias("turn"), role.alias("role"), h.alias("h"), F.length(text).alias("n"))
    each = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    lists = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.transform("t", lambda t: F.struct(t["h"].alias("h"), t["n"].alias("n"))).alias("turns"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, first, n, ids): the joined ids of each run of one key in a sorted batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key, ids = batch.column(0), batch.column(1)
        k = key.to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.flatnonzero(k[1:] != k[:-1]) + 1))
        ends = np.append(starts, len(k)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), ids.cast(pa.string()))
        yield pa.RecordBatch.from_arrays(
            [key.take(pa.array(starts)), ids.take(pa.array(starts)), pa.array(np.diff(ends).astype(np.int64)), pc.binary_join(lists, ",")],
            names=["key", "first", "n", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, lo, n, ends) of pieces sorted by key and first id, one running digest at a time."""
    now, lo, n, run = None, 0, 0, None
    for batch in batches:
        out: list[tuple] = []
        for key, first, count, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key == now:
                run.update(b",")
                n += count
            else:
                if now is not None:
                    out.append((now, lo, n, run.hexdigest()))
                now, lo, n, run = key, first, count, hashlib.sha256()
            run.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["key", "lo", "n", "ends"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (now, lo, n, run.hexdigest())], names=["key", "lo", "n", "ends"])


def _classes(sequences: DataFrame, scratch: Scratch) -> DataFrame:
    """Items of the first level: a path of one conversation or more, and what ends there."""
    hashes = F.unhex(F.array_join(F.transform("turns", lambda t: t["h"]), ""))
    sizes = F.unhex(F.array_join(F.transform("turns", lambda t: F.lpad(F.hex(t["n"].cast("long")), 8, "0")), ""))
    paths = scratch.table(sequences.select("conv_id", F.md5(hashes).alias("key"), hashes.alias("path"), sizes.alias("sizes")), "paths")
    ids = paths.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = ids.mapInArrow(_pieces, "key string, first long, n long, ids string")
    ends = pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key string, lo long, n long, ends string")
    zero = F.lit(0).cast("long")
    at = F.struct((F.length("path") / TURN).cast("int").alias("depth"), "n", "lo", "ends", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"))
    joined = ends.join(paths.select("conv_id", "path", "sizes"), F.col("lo") == F.col("conv_id"))
    return scratch.table(joined.select("path", "sizes", F.array(at).alias("at")), "classes")


def _common(turns: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Turns that each path has in common with the one before."""
    length = np.diff(ends)
    shorter = np.minimum(length[1:], length[:-1])
    row, place = spread(shorter)
    differ = (turns[ends[1:-1][row] + place] != turns[ends[:-2][row] + place]).any(axis=1)
    out = np.concatenate(([0], shorter))
    rows, first = np.unique(row[differ], return_index=True)
    out[rows + 1] = place[differ][first]
    return out


def _nodes_at(item: np.ndarray, depth: np.ndarray, common: np.ndarray, base: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Nodes of (item, depth) pairs in item order; ``base`` numbers each item's first new node."""
    node = base[item] + depth - common[item] - 1
    node[depth == 0] = 0
    older = np.flatnonzero((depth <= common[item]) & (depth > 0))
    if len(older):  # on spines only: the path so far, item by item
        path = np.zeros(int(length.max()) + 1, dtype=np.int64)
        wanted = np.split(older, np.flatnonzero(np.diff(item[older])) + 1)
        at = 0
        for some in wanted:
            while at <= item[some[0]]:
                new = np.arange(common[at] + 1, length[at] + 1)
                path[new] = base[at] + new - common[at] - 1
                at += 1
            node[some] = path[depth[some]]
    return node


def _keys(path: bytes, depth: int) -> list[str]:
    """Hashes of the path's prefixes of 0 to ``depth`` turns."""
    run, out = hashlib.md5(), []
    for d in range(depth + 1):
        out.append(run.hexdigest())
        run.update(path[d * TURN : (d + 1) * TURN])
    return out


def _shard(table: pa.Table, shard: int, upper: bool, last: bool) -> pa.RecordBatch:
    """Final nodes and the spines of a shard's sorted items."""
    raw, ends = binary_values(table.column("path"), np.uint8)
    ends = ends // TURN
    turns = raw.view(np.uint64).reshape(-1, 2)
    sizes = binary_values(table.column("sizes"), ">i4")[0].astype(np.int64)
    at = table.column("at").combine_chunks()
    at = pa.concat_arrays(at.chunks) if isinstance(at, pa.ChunkedArray) else at
    item = np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy()))
    here = {f.name: c for f, c in zip(at.type.value_type, at.flatten().flatten(), strict=True)}
    length, common = np.diff(ends), _common(turns, ends)

    closed = np.concatenate(([0], length[:-1] - common[1:]))
    opened = length - common
    opened[0] += 1  # the root
    counts = np.append(np.stack([closed, opened], axis=1).ravel(), [length[-1] + 1])
    tree = Parentheses(np.repeat(np.append(np.tile([-1, 1], len(length)), -1), counts))
    base = np.cumsum(opened) - opened
    base[0] = 1
    owner, place = spread(length - common)
    depth = np.concatenate(([0], common[owner] + 1 + place))
    size = np.concatenate(([0], sizes[ends[:-1][owner] + common[owner] + place]))
    total, stop = len(depth), tree.ends()

    node = _nodes_at(item, here["depth"].to_numpy().astype(np.int64), common, base, length)
    own = {c: np.zeros(total, dtype=np.int64) for c in ("n", "children", "leaves", "saved")}
    for c, v in own.items():
        np.add.at(v, node, here[c].to_numpy())
    lo = np.full(total, NOBODY)
    np.minimum.at(lo, node, here["lo"].to_numpy())
    lo = range_minima(lo, stop)
    ended = np.full(total, None, dtype=object)
    told = here["ends"].to_numpy(zero_copy_only=False)
    ended[node[told != None]] = told[told != None]  # noqa: E711 - an array

    spine = np.zeros(total, dtype=bool)
    if not last:
        spine[: length[0] + 1] = True
        spine[tree.find_close(np.arange(total)) >= len(tree.signs) - (length[-1] + 1)] = True
    # a node's parent is the last one before it that is less deep by one
    order = np.lexsort((np.arange(total), depth))
    key = depth[order] * total + order
    parent = np.append(-1, order[np.searchsorted(key, (depth[1:] - 1) * total + np.arange(1, total)) - 1])
    inside = np.flatnonzero(parent >= 0)
    final_child = inside[~spine[inside]]
    children = own["children"] + np.bincount(parent[final_child], minlength=total)
    leaf = tree.pairs() & (own["children"] == 0) & ~spine
    n = range_sums(own["n"], stop)
    leaves = range_sums(own["leaves"] + leaf, stop)
    saved = range_sums(own["saved"] + np.where(spine, 0, (n - 1) * size), stop)

    # spines: without what their children on spines have
    bound = inside[spine[inside]]
    below = {c: v.copy() for c, v in (("n", n), ("leaves", leaves), ("saved", saved))}
    for c, v in (("n", n), ("leaves", leaves), ("saved", saved)):
        np.subtract.at(below[c], parent[bound], v[bound])

    key_of = np.full(total, None, dtype=object)
    items = []
    paths, widths = table.column("path"), table.column("sizes")
    for i in () if last else dict.fromkeys((0, len(length) - 1)):
        path = paths[i].as_py()
        on = _nodes_at(np.full(length[i] + 1, i), np.arange(length[i] + 1), common, base, length)
        keys = _keys(path, int(length[i]))
        new = [x for x in range(len(on)) if key_of[on[x]] is None]
        for x in new:
            key_of[on[x]] = keys[x]
        items.append({
            "path": path, "sizes": widths[i].as_py(), "keys": [keys[x] for x in new],
            "at": [{"depth": x, "n": int(below["n"][v]), "lo": int(lo[v]), "ends": ended[v], "children": int(children[v]),
                    "leaves": int(below["leaves"][v]), "saved": int(below["saved"][v])} for x in new for v in (on[x],)],
        })
    if upper:  # these nodes were spines: shards below ask for them by key
        prefix = [_keys(p.as_py(), int(d)) for p, d in zip(paths, length, strict=True)]
        final_key = np.array([prefix[0][0]] + [prefix[o][d] for o, d in zip(owner, depth[1:], strict=True)], dtype=object)
    else:
        final_key = key_of

    final = np.flatnonzero(~spine)
    above = parent[final]
    known = (above >= 0) & ~spine[np.maximum(above, 0)]
    asked = (above >= 0) & ~known
    nodes = pa.StructArray.from_arrays(
        [
            pa.array(lo[final]), pa.array(depth[final]), pa.array(lo[np.maximum(above, 0)], mask=~known),
            pa.array(n[final]), pa.array(children[final]), pa.array(leaves[final]), pa.array(saved[final]),
            pa.array([x or EMPTY for x in ended[final]], pa.string()), pa.array(final_key[final], pa.string()),
            pa.array(np.where(asked, key_of[np.maximum(above, 0)], None), pa.string()),
        ],
        names=[c.split()[0] for c in NODE.split(", ")],
    )
    at_type = pa.list_(pa.struct([("depth", pa.int32()), *[(c, pa.int64()) for c in ("n", "lo")], ("ends", pa.string()), *[(c, pa.int64()) for c in ("children", "leaves", "saved")]]))
    item_type = pa.struct([("path", pa.binary()), ("sizes", pa.binary()), ("at", at_type), ("keys", pa.list_(pa.string()))])
    rows = len(final) + len(items)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(rows, shard)),
            pa.concat_arrays([nodes, pa.nulls(len(items), nodes.type)]),
            pa.concat_arrays([pa.nulls(len(final), item_type), pa.array(items, item_type)]),
        ],
        names=["shard", "node", "item"],
    )


def _level(items: DataFrame, level: int, shards: int, scratch: Scratch) -> DataFrame:
    last = shards == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            out = _shard(pa.Table.from_batches(held), (level << 32) + TaskContext.get().partitionId(), level > 0, last)
            for a in range(0, out.num_rows, 10_000):
                yield out.slice(a, 10_000)

    dealt = items.repartition(1) if last else items.repartitionByRange(shards, "path")
    return scratch.table(dealt.sortWithinPartitions("path").mapInArrow(run, OUT), f"level-{level}")


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row for each distinct prefix of ``sequences`` (conv_id, turns), as ``turn_sequences`` gives them; ids are unique."""
    scratch = Scratch(sequences.sparkSession, "trie")
    items, level, before = _classes(sequences, scratch), 0, None
    levels = []
    while True:
        held = items.agg(F.count("*").alias("items"), F.sum(F.length("path") / TURN).alias("turns")).first()
        shards = max(1, -(-int(held["turns"] or 0) // shard_turns))
        if before is not None:  # fewer at every level, however long the paths
            shards = min(shards, -(-before // 4))
        levels.append(_level(items, level, shards, scratch))
        if shards == 1:
            break
        items, before, level = levels[-1].where("item is not null").select("item.path", "item.sizes", "item.at"), shards, level + 1
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes = [x.where("node is not null").select("shard", "node.*") for x in levels]
    if len(levels) == 1:
        return nodes[0].select(*columns)
    every = nodes[0]
    for x in nodes[1:]:
        every = every.unionByName(x)
    # a shard's spine nodes under their final ids: what its other nodes can ask for, a key once a shard
    settled = every.where(F.col("shard") >= 1 << 32).select("key", F.col("conv_id").alias("found"))
    spines = [x.where("item is not null").select("shard", F.explode("item.keys").alias("key")) for x in levels[:-1]]
    asked = spines[0]
    for x in spines[1:]:
        asked = asked.unionByName(x)
    ids = asked.join(settled, "key").select("shard", F.col("key").alias("parent_key"), "found")
    ids = scratch.table(ids, "spine-ids")
    done = every.where("parent_key is null").select(*columns)
    waiting = every.where("parent_key is not null").drop("parent_conv_id").join(ids, ["shard", "parent_key"])
    return done.unionByName(waiting.withColumnRenamed("found", "parent_conv_id").select(*columns))
