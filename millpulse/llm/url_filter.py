"""Operator 5: URL filtering with a Bloom filter cascade.

A rule lists a host (with all its subdomains) and a path prefix.  A url's
candidate keys are its host's suffixes combined with its path's prefixes of
those lengths that rules have.  The key universe is the set of candidate keys of
the whole corpus.  The cascade's first level encodes the listed keys, the next
one the keys of the universe that pass it by mistake, the next one the listed
keys that pass that, and so on until nothing passes by mistake: for every key of
the universe the level that first denies it tells exactly whether it is listed.
Urls are then judged in a narrow pass without any join.  A second cascade, over
the listed keys, tells which of them block.

Levels are built from partial bit sets by ``bit_or``, so no set of keys is
gathered.  A cascade is collected and broadcast; listed keys beyond
``block_keys`` are dealt to several cascades by hash, applied in turn.

Defined cases: null urls and urls without ``://`` have empty host and path.  A
url that no rule fits is allowed.  The longest rule (host and path together;
then the longer host) wins.  Rules repeated with one verdict count once; a null
rule fits nothing.  Repeated pages get equal rows; empty tables give no rows.
Only the id and the url column are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

BITS_PER_KEY = 10
PROBES = 5
BLOCK_KEYS = 50_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Array of (host, path) keys, the longest first."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat_ws(".", F.slice(labels, i, n)))
    prefixes = F.array([F.lit(x) for x in sorted(lengths, reverse=True)]).cast("array<int>")
    fitting = F.filter(prefixes, lambda x: x <= F.length(path))

    def key(s: Column, x: Column) -> Column:
        return F.struct((-F.length(s) - x).alias("order"), (-F.length(s)).alias("then"), s.alias("host"), F.substring(path, F.lit(1), x).alias("path"))

    return F.array_sort(F.flatten(F.transform(suffixes, lambda s: F.transform(fitting, lambda x: key(s, x)))))


def key_hashes(host: Column, path: Column) -> Column:
    """Two independent hashes of a key."""
    return F.struct(F.xxhash64(host, path).alias("h1"), F.xxhash64(F.lit(7), path, host).alias("h2"))


def positions(h1: np.ndarray, h2: np.ndarray, bits: int, level: int) -> np.ndarray:
    """(keys, PROBES) bit positions; every level takes other ones."""
    a, b = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
    step = np.arange(1, PROBES + 1, dtype=np.uint64) + np.uint64(level * PROBES)
    mixed = (a[:, None] + b[:, None] * step) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(29))) % np.uint64(bits)


@dataclass
class Cascade:
    levels: list[np.ndarray]  # bit sets as words of 64

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        words = self.levels[level]
        at = positions(h1, h2, len(words) * 64, level)
        return ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for keys of the universe: denied first at an odd level, or never denied by an odd number of levels."""
        out = np.zeros(len(h1), dtype=bool)
        alive = np.arange(len(h1))
        for level in range(len(self.levels)):
            ok = self.passes(level, h1[alive], h2[alive])
            out[alive[~ok]] = level % 2 == 1
            alive = alive[ok]
        out[alive] = len(self.levels) % 2 == 1
        return out


def _encode(keys: DataFrame, level: int) -> np.ndarray:
    """The bit set of keys (h1, h2), by partially aggregated ``bit_or``."""
    words = max(1, -(-keys.count() * BITS_PER_KEY // 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = positions(batch.column(0).to_numpy(), batch.column(1).to_numpy(), words * 64, level).reshape(-1)
                at = np.unique(at)
                word, first = np.unique(at >> np.uint64(6), return_index=True)
                bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(bits.view(np.int64))], names=["word", "bits"])

    rows = keys.select("h1", "h2").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(words, dtype=np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _passing(keys: DataFrame, cascade: Cascade, level: int) -> DataFrame:
    """The keys that pass one level."""
    shared = keys.sparkSession.sparkContext.broadcast(Cascade([np.zeros(0, np.uint64)] * level + [cascade.levels[level]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.passes(level, batch.column(0).to_numpy(), batch.column(1).to_numpy())))

    return keys.select("h1", "h2").mapInArrow(run, "h1 long, h2 long")


def build_cascade(listed: DataFrame, universe: DataFrame, scratch: Scratch, name: str) -> Cascade:
    """A cascade that separates the keys (h1, h2) of ``listed`` from the rest of ``universe``."""
    inside = scratch.table(listed.select("h1", "h2").distinct(), f"{name}-listed")
    out = Cascade([_encode(inside, 0)])
    outside = scratch.table(_passing(universe, out, 0).distinct().join(inside, ["h1", "h2"], "left_anti"), f"{name}-passing-0")
    wrong, other = outside, inside
    while not wrong.isEmpty():
        level = len(out.levels)
        out.levels.append(_encode(wrong, level))
        wrong, other = scratch.table(_passing(other, out, level), f"{name}-passing-{level}"), wrong
    return out


def _first_listed(urls: DataFrame, cascades: list[Cascade], scratch: Scratch, name: str) -> DataFrame:
    """``best``: the place of each row's first key (h1, h2) that is listed, null without one.

    ``cascades`` are dealt by h1; each is applied in a pass of its own, written
    before the next one, so that an executor holds one cascade at a time.
    """
    blocks = len(cascades)
    out = urls.withColumn("best", F.lit(None).cast("int"))
    for block, cascade in enumerate(cascades):
        shared = urls.sparkSession.sparkContext.broadcast(cascade)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column(batch.num_columns - 2)
                flat, ends = keys.flatten(), keys.offsets.to_numpy()
                h1, h2 = (flat.field(k).to_numpy() for k in ("h1", "h2"))
                owner = np.repeat(np.arange(len(keys)), np.diff(ends))
                place = np.arange(len(flat)) - (ends[:-1] - ends[0])[owner]
                mine = h1 % blocks == block
                hit = np.zeros(len(flat), dtype=bool)
                hit[mine] = shared.value.listed(h1[mine], h2[mine])
                none = np.iinfo(np.int32).max
                best = batch.column(batch.num_columns - 1).fill_null(none).to_numpy().copy()
                np.minimum.at(best, owner[hit], place[hit].astype(np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(best, pa.int32(), mask=best == none)], names=batch.schema.names)

        out = out.mapInArrow(run, out.schema)
        if block < blocks - 1:
            out = scratch.table(out, f"{name}-pass-{block}")
            shared.unpersist()
            if block:
                scratch.drop(f"{name}-pass-{block - 1}")
    return out


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", block_keys: int = BLOCK_KEYS) -> DataFrame:
    """Per row: id, host, path, rule, verdict.  ``rules`` has host, path, verdict (allow or block)."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "urls")
    rules = scratch.table(rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").where("host is not null and path is not null").withColumn("k", key_hashes(F.col("host"), F.col("path"))).select("k.h1", "k.h2", "path", "verdict"), "rules")
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    keyed = urls.withColumn("c", candidate_keys(F.col("host"), F.col("path"), lengths) if lengths else F.expr("cast(array() as array<struct<order:int,then:int,host:string,path:string>>)"))
    hashed = F.transform("c", lambda x: F.struct(F.xxhash64(x["host"], x["path"]).alias("h1"), F.xxhash64(F.lit(7), x["path"], x["host"]).alias("h2"), F.concat(x["host"], x["path"]).alias("rule")))
    keyed = keyed.select("id", "host", "path", hashed.alias("keys"))
    universe = scratch.table(keyed.select(F.explode("keys").alias("k")).select("k.h1", "k.h2").distinct(), "universe")
    listed = rules.select("h1", "h2").distinct()
    blocks = max(1, -(-listed.count() // block_keys))
    mine = [F.pmod("h1", F.lit(blocks)) == b for b in range(blocks)]
    member = [build_cascade(listed.where(m), universe.where(m), scratch, f"listed-{b}") for b, m in enumerate(mine)]
    found = _first_listed(keyed, member, scratch, "member").withColumn("k", F.when(F.col("best").isNotNull(), F.element_at("keys", F.coalesce("best", F.lit(0)) + 1)))
    found = found.select("id", "host", "path", F.col("k.rule").alias("rule"), F.when(F.col("k").isNull(), F.array()).otherwise(F.array(F.struct("k.h1", "k.h2"))).alias("keys"))
    # among the listed keys, those that block
    blocking = rules.where("verdict = 'block'")
    stops = [build_cascade(blocking.where(m), listed.where(m), scratch, f"block-{b}") for b, m in enumerate(mine)]
    out = _first_listed(found, stops, scratch, "stops")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.when(F.col("best").isNull(), "allow").otherwise("block").alias("verdict"))
