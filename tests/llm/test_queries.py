"""The registered queries on whole tables: SQL oracles where there are any, else contract columns, row counts and brute force."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as entry_mod
from millpulse.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL, compare_with_oracle
from tests.llm.helpers import WS, contamination, near_groups, repeated_cover, sha, shingle_set

#: Columns of the contracts and the table whose rows the result has (None: pieces).
CONTRACT = {
    "op1_line_dedup": (["doc_id", "n_lines", "n_removed", "text"], "documents"),
    "op2_minhash_dedup": (["doc_id", "n_shingles", "component_id", "kept"], "documents"),
    "op3_best_fit_packing": (["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"], None),
    "op4_embedding_dedup": (["vec_id", "n_links", "component_id", "kept"], "embeddings"),
    "op5_url_filter": (["page_id", "host", "path", "rule", "verdict"], "pages"),
    "op6_substring_dedup": (["doc_id", "n_words", "n_removed", "kept_sha256"], "documents"),
    "op7_decontamination": (["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"], "documents"),
    "op8_language_id": (["doc_id", "held_out", "lang_pred", "score"], "documents"),
    "op9_suffix_array_dedup": (["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], "documents"),
    "op10_pii_surrogates": (["doc_id", "n_entities", "text"], "documents"),
    "op11_embedding_whitening": (["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"], None),
    "op12_conversation_trie": (["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"], None),
    "op13_hilbert_sharding": (["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"], "documents"),
}


def test_all_are_registered():
    assert set(CONTRACT) == set(QUERIES)
    assert {*QUERIES, "pipeline"} <= set(entry_mod.queries())
    assert set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    compare_with_oracle(QUERIES[name](spark, SF_ORACLE), ORACLE[name], SF_ORACLE)


@pytest.mark.parametrize("name", sorted(set(CONTRACT) - set(ORACLE)))
def test_query_returns_its_contract(spark, name):
    columns, table = CONTRACT[name]
    out = QUERIES[name](spark, SF_SMALL)
    assert out.columns == columns
    want = spark.read.parquet(f"{SF_SMALL}/{table or 'documents'}.parquet").count()
    got = out.count()
    assert got == want if table else got >= want


def _near(texts, ids, spark):
    found = near_groups(texts)
    return [(len(shingle_set(t)), ids[r], ids[r] == i) for t, i, r in zip(texts, ids, found, strict=True)]


def _substrings(texts, ids, spark):
    words = [WS.findall(t or "") for t in texts]
    return [(len(w), sum(g), sha(" ".join(x for x, q in zip(w, g, strict=True) if not q).encode())) for w, g in zip(words, repeated_cover(words, 35), strict=True)]


def _bytes(texts, ids, spark):
    raw = [(t or "").encode() for t in texts]
    windows = [[hash(b[i : i + 400]) for i in range(len(b) - 399)] for b in raw]
    count = Counter(x for w in windows for x in w)
    out = []
    for b, w in zip(raw, windows, strict=True):
        gone = bytearray(len(b))
        for i, x in enumerate(w):
            if count[x] > 1:
                gone[i : i + 400] = b"\1" * 400
        spans = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out


def _hits(texts, ids, spark):
    return contamination(texts, [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").select("item_id", "text").collect()])


@pytest.mark.parametrize(
    "name, brute",
    [("op2_minhash_dedup", _near), ("op6_substring_dedup", _substrings), ("op7_decontamination", _hits), ("op9_suffix_array_dedup", _bytes)],
)
def test_query_equals_brute_force_on_the_whole_table(spark, name, brute):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    ids = [r["doc_id"] for r in docs]
    want = dict(zip(ids, brute([r["text"] for r in docs], ids, spark), strict=True))
    columns = CONTRACT[name][0][1:]
    got = {r["doc_id"]: tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF_ORACLE).collect()}
    assert len(docs) > 900 and got == want
