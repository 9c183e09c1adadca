"""Operators 12 and 13 against brute force."""

from __future__ import annotations

import glob
import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millpulse.llm.parentheses import Parentheses, range_minima, range_sums
from millpulse.llm.prefix_trie import prefix_trie, turn_sequences
from millpulse.llm.queries import op12_conversation_trie, op13_hilbert_sharding, rebuilt
from millpulse.llm.sharding import bounds, hilbert, shard_documents, write_shards
from millpulse.llm.common import Scratch
from tests.conftest import SF_ORACLE, SF_SMALL

TURNS = "conv_id long, turn int, role string, text string"


# -- 12: conversations ------------------------------------------------------------


def trie_of(rows) -> list[tuple]:
    """The contract on (conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turn_key = (turn is not None, turn or 0, role or "", hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest())
            own[c].append((turn_key, (role or "", text or "")))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    return nodes_of({c: own.get(c - c % 100, [])[: zlib.crc32(str(c).encode()) % 6] + t[zlib.crc32(str(c).encode()) % 6 :] for c, t in own.items()})


def nodes_of(paths: dict) -> list[tuple]:
    members, ended = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ended[tuple(path)].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(ended[k]))).encode()).hexdigest())
        for k, m in members.items()
    )


def collected(df) -> list[tuple]:
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()))


def test_parentheses_against_recursion():
    rng = random.Random(3)
    for size in (1, 2, 5, 64, 700):
        parent = [-1] + [rng.randrange(max(0, v - rng.choice((1, 3, 200))), v) for v in range(1, size)]
        kids = defaultdict(list)
        for v in range(1, size):
            kids[parent[v]].append(v)
        signs, order, close = [], [], {}

        todo = [(0, False)]
        while todo:
            v, done = todo.pop()
            if done:
                close[v] = len(signs)
                signs.append(-1)
            else:
                order.append(v)
                signs.append(1)
                todo += [(v, True), *((k, False) for k in reversed(kids[v]))]
        tree = Parentheses(np.array(signs))
        assert tree.find_close(np.arange(size)).tolist() == [close[v] for v in order]
        assert tree.pairs().tolist() == [not kids[v] for v in order]
        values, stop = np.array([rng.randrange(99) for _ in range(size)]), tree.ends()
        assert range_sums(values, stop).tolist() == [values[v : stop[v]].sum() for v in range(size)]
        assert range_minima(values, stop).tolist() == [values[v : stop[v]].min() for v in range(size)]


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(5)
    out = []
    for c in range(260):
        if c % 17 == 3:
            continue  # absent ids, some of them first of their block
        length = rng.randint(1, 8) if c % 50 else 40
        out += [(c, t, ["user", "assistant"][t % 2], f"text {rng.randrange(3)}") for t in range(length)]
    out += [(1000 + c, t, "user", f"hot {t}") for c in range(150) for t in range(3)]  # a common conversation, its block's first absent
    out += [(900, t, "user", "x") for t in range(2)] + [(901, 0, "user", "y"), (902, 0, None, None), (902, None, "user", "\U0001f600 ä")]
    out += [(903, 1, "user", "tie"), (903, 1, "user", "tie"), (903, 1, "a", "tie 2"), (None, 0, "user", "nobody"), (-5, 0, "user", ""), (-5, 1, None, "z")]
    return [r for r in out if r[0] is None or r[0] >= 0]


@pytest.mark.parametrize("shard_turns", [1_000_000, 60, 7])
def test_trie_equals_brute_force_at_every_number_of_levels(spark, turns, shard_turns):
    rows = spark.createDataFrame(turns, TURNS).repartition(6)
    got = collected(prefix_trie(rebuilt(turn_sequences(rows)), shard_turns))
    assert got == trie_of(turns)


def test_trie_of_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(op12_conversation_trie(spark, SF_ORACLE)) == trie_of(rows)


def test_trie_odd_inputs(spark):
    assert collected(prefix_trie(rebuilt(turn_sequences(spark.createDataFrame([], TURNS))))) == []
    none = spark.createDataFrame([(None, 1, "user", "x")], TURNS)
    assert collected(prefix_trie(rebuilt(turn_sequences(none)))) == []
    one = spark.createDataFrame([(7, None, None, None)], TURNS).withColumns({c: F.lit("x") for c in ("h", "n", "key", "path", "shard", "ends", "turns")})
    assert collected(prefix_trie(turn_sequences(one))) == nodes_of({7: [("", "")]})
    # turnless sequences are members of the root only
    bare = spark.createDataFrame([(4, []), (2, [])], "conv_id long, turns array<struct<h string, n int>>")
    assert collected(prefix_trie(bare)) == nodes_of({4: [], 2: []})


def test_trie_with_a_long_conversation_and_long_texts(spark):
    rows = [(1, t, "user", "long " * 20_000 if t == 3 else f"t{t}") for t in range(3000)] + [(2, t, "user", f"t{t}") for t in range(2)]
    got = collected(prefix_trie(turn_sequences(spark.createDataFrame(rows, TURNS)), 500))
    want = nodes_of({1: [(r[2], r[3]) for r in rows[:60]], 2: [(r[2], r[3]) for r in rows[3000:]]})
    assert len(got) == 3001 and max(g[1] for g in got) == 3000
    assert {g[:4] for g in got if g[1] <= 3} == {w[:4] for w in want if w[1] <= 3}
    assert [g for g in got if g[1] == 0][0][6] == 4  # two shared turns of two code points


# -- 13: shards -------------------------------------------------------------------


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 1), (2, 5), (3, 3), (4, 2)])
def test_hilbert_visits_every_cell_by_steps_of_one(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = hilbert(list(cells.T), bits)
    assert sorted(place) == list(range(len(cells)))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
    # every aligned stretch of 2 ** dims cells is a box of side 2: short runs are compact
    if bits > 1:
        boxes = (walk // 2).reshape(-1, 1 << dims, dims)
        assert (boxes == boxes[:, :1]).all()


def brute_bins(values: list, bits: int) -> dict:
    count = Counter(values)
    out, before = {}, 0
    for v in sorted(count, key=lambda v: (v is not None, v)):
        out[v] = 0 if v is None else before * (1 << bits) // len(values)
        before += count[v]
    return out


def brute_shards(rows, shards, law) -> list[tuple]:
    """(doc_id, size, crc, shard, slot) of rows (doc_id, text, lang, source, n_chars)."""
    bins = [brute_bins([r[i] for r in rows], 5) for i in (2, 3, 4)]
    curve = hilbert([np.array([b[r[i]] for r in rows]) for b, i in zip(bins, (2, 3, 4), strict=True)], 5)
    raw = [(r[1] or "").encode() for r in rows]
    key = [(int(c), zlib.crc32(b), len(b) + 8, r[0] is not None, r[0] or 0) for c, b, r in zip(curve, raw, rows, strict=True)]
    order = sorted(range(len(rows)), key=lambda i: key[i])
    total = len(rows) if law == "rows" else sum(len(b) + 8 for b in raw)
    out, before, slots = [], 0, Counter()
    for rank, i in enumerate(order):
        shard = (rank if law == "rows" else before) * shards // total
        out.append((rows[i][0], len(raw[i]) + 8, zlib.crc32(raw[i]), shard, slots[shard]))
        slots[shard] += 1
        before += len(raw[i]) + 8
    return sorted(out, key=str)


def placed(df) -> list[tuple]:
    return sorted(map(tuple, df.select("row.doc_id", "size", "text_crc32", "shard", "slot").collect()), key=str)


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards_equal_brute_force(spark, rows, docs, law):
    got = placed(shard_documents(docs, shards=7, law=law))
    assert got == brute_shards(rows, 7, law)
    size = Counter()
    for r in got:
        size[r[3]] += 1 if law == "rows" else r[1]
    most = 1 if law == "rows" else max(r[1] for r in got)
    assert max(size.values()) - min(size.values()) <= 2 * most - (law == "rows")


def test_shards_of_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    out = op13_hilbert_sharding(spark, SF_ORACLE)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = out.collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got), key=str) == brute_shards(rows, 24, "rows")
    count = Counter(r.shard for r in got)
    assert set(count) == set(range(24)) and max(count.values()) - min(count.values()) <= 1
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_shards_odd_inputs(spark, odd, empty, docs):
    got = placed(shard_documents(odd, shards=4))
    assert [r[0] for r in got].count(900004) == 2 and [r[0] for r in got].count(None) == 2
    assert Counter(r[3] for r in got) == {0: 3, 1: 2, 2: 2, 3: 2}
    assert (900001, 8, 0) in {r[:3] for r in got} and (900002, 8, 0) in {r[:3] for r in got}
    assert placed(shard_documents(empty)) == []
    for law in ("rows", "bytes"):
        one = placed(shard_documents(docs.limit(1), shards=24, law=law))
        assert len(one) == 1 and one[0][3:] == (0, 0)
    clash = docs.withColumns({c: F.lit(1) for c in ("row", "id", "size", "rank", "before", "weight", "at", "part", "shard", "slot", "curve", "dim0", "nth")})
    out = shard_documents(clash, shards=7)
    assert placed(out) == placed(shard_documents(docs, shards=7)) and out.select("row.*").columns == clash.columns
    with pytest.raises(ValueError):
        shard_documents(docs, law="key")
    with pytest.raises(ValueError):
        shard_documents(docs, dims=[])


def test_a_hot_row_is_split(spark):
    """One document repeated: all ranks are given, to all shards."""
    hot = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(4).cast("long").alias("n_chars"))
    got = placed(shard_documents(hot))
    assert sorted(Counter(r[3] for r in got).values()) == [208] * 16 + [209] * 8
    assert len({r[3:] for r in got}) == 5000


def test_bounds_of_dates_and_floats(spark):
    df = spark.sql("SELECT date_add(DATE'2024-01-01', cast(id AS int)) AS d, CASE WHEN id % 9 = 0 THEN double('nan') ELSE id / 7 END AS x FROM range(64)")
    scratch = Scratch(spark, "bounds")
    assert len(bounds(df, "d", 4, 64, scratch)) == 16
    assert [b for _, b in bounds(df, "x", 2, 64, scratch)] == [0, 1, 2, 3]


def test_files_prune_in_every_dimension(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    write_shards(shard_documents(docs), str(tmp_path / "curve"))
    docs.repartition(24).write.parquet(str(tmp_path / "any"))
    back = spark.read.parquet(str(tmp_path / "curve"))
    assert back.count() == docs.count() and set(back.columns) == {*docs.columns, "_shard"}

    def touched(folder: str, column: str, value) -> int:
        n = 0
        for f in glob.glob(f"{tmp_path}/{folder}/**/*.parquet", recursive=True):
            meta = pq.ParquetFile(f).metadata
            at = [meta.schema.column(i).name for i in range(len(meta.schema))].index(column)
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            n += any(s.has_min_max and s.min <= value <= s.max for s in stats)
        return n

    lang = docs.groupBy("lang").count().orderBy("count").first()["lang"]
    source = docs.groupBy("source").count().orderBy("count").first()["source"]
    for column, value in (("lang", lang), ("source", source), ("n_chars", 300)):
        assert touched("curve", column, value) <= 0.6 * touched("any", column, value)


def test_small_table_queries(spark):
    assert op13_hilbert_sharding(spark, SF_SMALL).count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_result_columns_that_the_input_has_already(spark, docs):
    """Lines and entities under a free name, the input's own columns as they were."""
    from millpulse.llm.line_dedup import deduplicate_lines
    from millpulse.llm.pii import replace_pii

    clash = docs.withColumns({"_lines": F.col("doc_id"), "_entities": F.col("doc_id"), "_Entities_": F.lit(1)})
    lines, plain = deduplicate_lines(clash), deduplicate_lines(docs)
    assert lines.columns == [*clash.columns, "_lines_"]
    assert sorted(map(tuple, lines.where("_lines = doc_id").select("doc_id", "text", "_lines_").collect())) == sorted(map(tuple, plain.select("doc_id", "text", "_lines").collect()))
    out = replace_pii(clash, key="k")
    assert out.columns == [*clash.columns, "_entities__"] and out.where("_entities = doc_id").count() == docs.count()
