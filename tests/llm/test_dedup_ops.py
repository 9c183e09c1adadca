"""Operators 1, 2, 6 and 9 against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from millpulse.llm import line_dedup, minhash_dedup, substring_dedup, suffix_dedup
from millpulse.llm.common import Scratch
from millpulse.llm.graph import components
from millpulse.llm.suffix import suffix_array
from tests.llm.helpers import ODD, WS, near_groups, repeated_cover, roots, sha, shingle_set, without_later_lines


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_near_duplicates_equal_brute_force(docs, rows):
    got = by_id(minhash_dedup.near_duplicates(docs))
    want = near_groups([t for _, t, *_ in rows])
    for (i, text, *_), root in zip(rows, want, strict=True):
        r = got[i]
        assert (r["n_shingles"], r["component_id"], r["kept"], r["first"]) == (len(shingle_set(text)), root, root == i, root == i)


def test_near_duplicates_in_blocks_are_the_same(docs):
    """A cluster larger than a block is compared block against block."""
    whole, cut = (by_id(minhash_dedup.near_duplicates(docs, block_sets=n)) for n in (1024, 3))
    assert whole == cut


def test_near_duplicates_odd_rows(odd):
    got = minhash_dedup.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    for r in got:
        if r["doc_id"] is not None:
            assert r["component_id"] == r["doc_id"] and r["kept"]
        else:
            assert r["component_id"] is None and r["kept"]
    assert sorted(r["n_shingles"] for r in got if r["doc_id"] == 900004) == [1, 1]
    kept = minhash_dedup.keep_one(odd).collect()
    assert sum(r["doc_id"] == 900004 for r in kept) == 1 and len(kept) == len(ODD) - 1


def test_keep_one_keeps_columns_and_one_of_each_group(docs, clashing, rows):
    want = {i for i, root in enumerate(near_groups([t for _, t, *_ in rows])) if i == root}
    out = minhash_dedup.keep_one(clashing)
    assert out.columns == clashing.columns
    assert {r["doc_id"] for r in out.collect()} == want


def test_components_of_paths_stars_and_repeats(spark, tmp_path):
    rng = np.random.default_rng(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 7)] + rng.integers(1000, 1100, (60, 2)).tolist()
    df = spark.createDataFrame(links + links[:20], "u long, v long")
    got = {r["node"]: r["root"] for r in components(df, Scratch(spark, "test")).collect()}
    want = roots({x for p in links for x in p}, links)
    assert all(got.get(n, n) == r for n, r in want.items()) and set(got) <= set(want)


def test_line_dedup_equals_brute_force(clashing, rows):
    want = without_later_lines([t for _, t, *_ in rows], 3, 50)
    out = line_dedup.deduplicate_lines(clashing)
    assert out.columns == [*clashing.columns, "_lines"]
    got = by_id(out)
    for (i, text, *_), expected in zip(rows, want, strict=True):
        assert got[i]["text"] == expected, i
        assert got[i]["_lines"]["removed"] == sum(1 for x in text.split("\n") if x.strip()) - sum(1 for x in expected.split("\n") if x.strip()) or expected == ""


@pytest.mark.parametrize("depth", [1, 2, 5])
def test_line_dedup_other_depths(spark, depth):
    rng = np.random.default_rng(depth)
    texts = ["\n".join(rng.choice(list("abc") + [""], rng.integers(0, 14))) for _ in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(line_dedup.deduplicate_lines(df, min_lines=depth))
    assert [got[i]["text"] for i in range(12)] == without_later_lines(texts, depth, 50)


@pytest.mark.parametrize("depth", [2, 3, 4, 6])
def test_runs_of_few_lines_count_by_their_words(spark, depth):
    rng = np.random.default_rng(depth)
    lines = [" ".join(f"{c}{k}" for k in range(n)) for c, n in zip("abcdef", (1, 3, 9, 10, 11, 20), strict=True)]
    texts = ["\n".join(rng.choice([*lines, ""], rng.integers(0, 14))) for _ in range(14)]
    df = spark.createDataFrame(list(enumerate(texts)) * 2, "doc_id long, text string")
    got = by_id(line_dedup.deduplicate_lines(df, min_lines=depth, min_words=20))
    assert [got[i]["text"] for i in range(14)] == without_later_lines(texts, depth, 20)


def test_two_repeated_lines_of_98_words_go(spark):
    two = "\n".join(" ".join(f"{c}{k}" for k in range(49)) for c in "ab")
    texts = [f"one x\n{two}\none y", f"two x\n{two}\ntwo y", f"three x\n{two}", "\n".join(two.split("\n")[:1])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(line_dedup.deduplicate_lines(df))
    assert [got[i]["_lines"]["removed"] for i in range(4)] == [0, 2, 2, 0] and got[1]["text"] == "two x\ntwo y"


def test_copies_of_a_document_of_many_lines(spark):
    """Time that grows with the square of the lines would take hours here."""
    text = "\n".join(f"line {k}" for k in range(100_000))
    df = spark.createDataFrame([(1, text), (2, text + "\nits own end")], "doc_id long, text string")
    got = by_id(line_dedup.deduplicate_lines(df))
    assert got[1]["_lines"]["removed"] == 0 and (got[2]["text"], got[2]["_lines"]["removed"]) == ("its own end", 100_000)


def test_line_dedup_odd_and_empty(odd, empty):
    got = line_dedup.deduplicate_lines(odd).collect()
    assert sorted(str(r["text"]) for r in got) == sorted(str(t) for _, t, *_ in ODD)
    assert line_dedup.deduplicate_lines(empty).count() == 0


def _substring(texts):
    words = [WS.findall(t or "") for t in texts]
    return [(len(w), sum(g), sha(" ".join(x for x, q in zip(w, g, strict=True) if not q).encode())) for w, g in zip(words, repeated_cover(words, 35), strict=True)]


def _bytes(texts):
    raw = [list((t or "").encode()) for t in texts]
    out = []
    for b, g in zip(raw, repeated_cover(raw, 400), strict=True):
        spans = sum(1 for k, x in enumerate(g) if x and (k == 0 or not g[k - 1]))
        out.append((len(b), sum(g), spans, sha(bytes(x for x, q in zip(b, g, strict=True) if not q))))
    return out


@pytest.mark.parametrize("hot", [None, 0])
def test_substring_dedup_equals_brute_force(clashing, rows, monkeypatch, hot):
    if hot is not None:  # every anchor is cut as a hot one would be
        monkeypatch.setattr(substring_dedup, "HOT", hot)
    got = by_id(substring_dedup.remove_repeats(clashing))
    want = _substring([t for _, t, *_ in rows])
    assert sum(w[1] for w in want) > 0
    for (i, *_), w in zip(rows, want, strict=True):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == w
        assert sha(got[i]["kept_text"].encode()) == w[2]


@pytest.mark.parametrize("hot", [None, 0])
def test_suffix_dedup_equals_brute_force(clashing, rows, monkeypatch, hot):
    if hot is not None:
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = by_id(suffix_dedup.remove_repeated_bytes(clashing))
    want = _bytes([t for _, t, *_ in rows])
    assert sum(w[1] for w in want) > 0
    for (i, *_), w in zip(rows, want, strict=True):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == w


@pytest.mark.parametrize("run, brute", [(substring_dedup.remove_repeats, _substring), (suffix_dedup.remove_repeated_bytes, _bytes)])
def test_repeat_removal_odd_and_empty(odd, empty, run, brute):
    got = sorted((str(r[0]), *r[1:-1]) for r in run(odd).collect())
    want = sorted((str(o[0]), *w) for o, w in zip(ODD, brute([t for _, t, *_ in ODD]), strict=True))
    assert got == want
    assert run(empty).count() == 0


def test_suffix_arrays():
    rng = np.random.default_rng(1)
    for trial in range(120):
        k = int(rng.integers(1, 5))
        t = rng.integers(1, k + 1, int(rng.integers(1, 300)))
        if trial % 3 == 0:
            t = np.tile(t, 3)
        t = np.append(t, 0).astype(np.int32)
        seq = t.tolist()
        assert suffix_array(t, k + 1).tolist() == sorted(range(len(seq)), key=lambda i: seq[i:])
