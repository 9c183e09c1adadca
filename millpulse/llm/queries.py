"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, table
from .decontaminate import find_contamination
from .embedding_dedup import link_vectors
from .language_id import identify
from .line_dedup import deduplicate_lines
from .minhash_dedup import near_duplicates
from .packing import pack_documents
from .pii import replace_pii
from .prefix_trie import prefix_trie, turn_sequences
from .sharding import shard_documents
from .substring_dedup import remove_repeats
from .suffix_dedup import remove_repeated_bytes
from .url_filter import judge_urls
from .whitening import whiten


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicate_lines(documents(spark, sf_dir))
    return out.select("doc_id", F.col("_lines.total").alias("n_lines"), F.col("_lines.removed").alias("n_removed"), "text")


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.drop("spans", "items", "clean_text")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir)).drop("coverage")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


#: The rules of the registered query: (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("kept_text")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(documents(spark, sf_dir)).drop("kept_bytes")


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replace_pii(documents(spark, sf_dir), key="registered query: a key that is not secret")
    return out.select("doc_id", F.col("_entities").alias("n_entities"), "text")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    out = whiten(table(spark, sf_dir, "embeddings")).select("id", "n", "deviation", "identity_error", each)
    return out.select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), "n", F.col("deviation").try_cast("long").alias("deviation"),
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error",
    )


def rebuilt(sequences: DataFrame, block: int = 100, heads: int = 6) -> DataFrame:
    """Each conversation after the first turns of its block's first one: as many as a checksum of its id says."""
    first = F.col("conv_id") - F.col("conv_id") % block
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    head = sequences.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("first"), F.slice("turns", 1, heads - 1).alias("head"))
    joined = sequences.withColumn("first", first).join(head, "first", "left").withColumn("h", h)
    kept = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    given = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(given, kept).alias("turns"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(turn_sequences(table(spark, sf_dir, "conversations"))))


def op13_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(documents(spark, sf_dir), keep=["doc_id"])
    return out.select("row.doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_language_id": op8_language_id,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_pii_surrogates": op10_pii_surrogates,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_hilbert_sharding": op13_hilbert_sharding,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": r"""
        WITH every AS (
            SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents
        ), seq AS (
            SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM every WHERE NOT regexp_full_match(line, '\s*')
        ), runs AS (
            SELECT doc_id, i, p, line,
                   lead(line, 1) OVER w AS line2, lead(line, 2) OVER w AS line3, words, words + lead(words, 1) OVER w AS words2
            FROM (SELECT *, len(string_split_regex(trim(line), '\s+')) AS words FROM seq) WINDOW w AS (PARTITION BY doc_id ORDER BY p)
        ), marked AS (
            SELECT doc_id, p, words, words2,
                   row_number() OVER (PARTITION BY line ORDER BY doc_id, p) AS nth1,
                   CASE WHEN line2 IS NOT NULL THEN row_number() OVER (PARTITION BY line, line2 ORDER BY doc_id, p) END AS nth2,
                   CASE WHEN line3 IS NOT NULL THEN row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, p) END AS nth3
            FROM runs
        ), gone AS (
            SELECT doc_id, p FROM marked WHERE words >= 50 AND nth1 > 1
            UNION SELECT doc_id, p + k FROM marked, (VALUES (0), (1)) AS t(k) WHERE words2 >= 50 AND nth2 > 1
            UNION SELECT doc_id, p + k FROM marked, (VALUES (0), (1), (2)) AS t(k) WHERE nth3 > 1
        ), kept AS (
            SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.i) AS text
            FROM every e LEFT JOIN seq s ON s.doc_id = e.doc_id AND s.i = e.i LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.p = s.p
            WHERE g.p IS NULL GROUP BY e.doc_id
        )
        SELECT d.doc_id, coalesce(n.n_lines, 0) AS n_lines, coalesce(r.n_removed, 0) AS n_removed,
               CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
        FROM documents d
        LEFT JOIN (SELECT doc_id, count(*) AS n_lines FROM seq GROUP BY doc_id) n USING (doc_id)
        LEFT JOIN (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id) r USING (doc_id)
        LEFT JOIN kept k USING (doc_id)
    """,
    "op5_url_filter": """
        WITH parts AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), hosts AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts
        ), rules(rhost, rpath, says) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), best AS (
            SELECT page_id, max_by(rhost || rpath, length(rhost) + length(rpath)) AS rule, max_by(says, length(rhost) + length(rpath)) AS says
            FROM hosts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
            GROUP BY page_id
        )
        SELECT h.page_id, h.host, h.path, b.rule, coalesce(b.says, 'allow') AS verdict
        FROM hosts h LEFT JOIN best b USING (page_id)
    """,
    "op12_conversation_trie": r"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 100 AS first,
                   xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
                                   lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM turns)
        ), rebuilt AS (
            SELECT c.conv_id, t.p, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.first AND t.p <= c.h
            UNION ALL
            SELECT c.conv_id, c.h + t.p, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h
        ), placed AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS d, length(text) AS size, md5(length(role) || ':' || role || text) AS turn FROM rebuilt
        ), prefixes AS (
            SELECT conv_id, d, size, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY d) AS key FROM placed
            UNION ALL SELECT conv_id, 0, 0, '' FROM convs
        ), ends AS (
            SELECT conv_id, max_by(key, d) AS key FROM prefixes GROUP BY conv_id
        ), digests AS (
            SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest FROM ends GROUP BY key
        ), nodes AS (
            SELECT key, d, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * max(size) AS saved FROM prefixes GROUP BY key, d
        ), linked AS (
            SELECT a.*, b.key AS above, b.conv_id AS parent FROM nodes a LEFT JOIN nodes b ON b.d = a.d - 1 AND b.key = left(a.key, greatest(32 * (a.d - 1), 0)::BIGINT)
        ), families AS (
            SELECT above AS key, d - 1 AS d, count(*) AS children FROM linked WHERE above IS NOT NULL GROUP BY ALL
        ), totals AS (
            SELECT p.key, p.d, sum(n.saved) AS saved, count(*) FILTER (WHERE f.children IS NULL) AS leaves
            FROM nodes n LEFT JOIN families f ON f.key = n.key AND f.d = n.d JOIN prefixes p ON p.conv_id = n.conv_id AND p.d <= n.d
            GROUP BY p.key, p.d
        )
        SELECT l.conv_id, l.d::BIGINT AS depth, l.parent AS parent_conv_id, l.n AS n_convs, coalesce(f.children, 0) AS n_children, t.leaves AS n_leaves,
               t.saved::BIGINT AS saved_tokens, coalesce(g.digest, sha256('')) AS ends_sha256
        FROM linked l JOIN totals t ON t.key = l.key AND t.d = l.d LEFT JOIN families f ON f.key = l.key AND f.d = l.d LEFT JOIN digests g ON g.key = l.key
    """,
    "op13_hilbert_sharding": r"""
        WITH crc_step AS (
            SELECT list_transform(range(256), lambda i: list_reduce([i, -1, -1, -1, -1, -1, -1, -1, -1], lambda c, s: xor(c >> 1, 3988292384 * (c & 1)))) AS step
        ), docs AS (
            SELECT row_number() OVER () AS nth, doc_id, lang, source, n_chars, strlen(coalesce(text, '')) + 8 AS size,
                   xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
                                   lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) AS crc
            FROM documents, crc_step
        ), lang_bins AS (
            SELECT lang AS v, ((sum(n) OVER (ORDER BY lang NULLS FIRST) - n) * 32 // sum(n) OVER ())::BIGINT AS bin FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
        ), source_bins AS (
            SELECT source AS v, ((sum(n) OVER (ORDER BY source NULLS FIRST) - n) * 32 // sum(n) OVER ())::BIGINT AS bin FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)
        ), length_bins AS (
            SELECT n_chars AS v, ((sum(n) OVER (ORDER BY n_chars NULLS FIRST) - n) * 32 // sum(n) OVER ())::BIGINT AS bin FROM (SELECT n_chars, count(*) AS n FROM documents GROUP BY n_chars)
        ), cells AS (
            SELECT d.*, CASE WHEN d.lang IS NULL THEN 0 ELSE a.bin END AS a, CASE WHEN d.source IS NULL THEN 0 ELSE b.bin END AS b, CASE WHEN d.n_chars IS NULL THEN 0 ELSE c.bin END AS c
            FROM docs d JOIN lang_bins a ON a.v IS NOT DISTINCT FROM d.lang JOIN source_bins b ON b.v IS NOT DISTINCT FROM d.source JOIN length_bins c ON c.v IS NOT DISTINCT FROM d.n_chars
        ), turned AS (  -- each step: bit, axis
            SELECT *, list_reduce([[a, b, c], [16, 1, 0], [16, 2, 0], [16, 3, 0], [8, 1, 0], [8, 2, 0], [8, 3, 0], [4, 1, 0], [4, 2, 0], [4, 3, 0], [2, 1, 0], [2, 2, 0], [2, 3, 0]],
                lambda s, t: CASE WHEN s[t[2]] & t[1] > 0 THEN [xor(s[1], t[1] - 1), s[2], s[3]]
                    ELSE [xor(s[1], xor(s[1], s[t[2]]) & (t[1] - 1)),
                          CASE WHEN t[2] = 2 THEN xor(s[2], xor(s[1], s[2]) & (t[1] - 1)) ELSE s[2] END,
                          CASE WHEN t[2] = 3 THEN xor(s[3], xor(s[1], s[3]) & (t[1] - 1)) ELSE s[3] END] END) AS x
            FROM cells
        ), gray AS (
            SELECT *, x[1] AS x1, xor(x[1], x[2]) AS x2, xor(xor(x[1], x[2]), x[3]) AS x3 FROM turned
        ), flipped AS (
            SELECT *, xor(xor(CASE WHEN x3 & 16 > 0 THEN 15 ELSE 0 END, CASE WHEN x3 & 8 > 0 THEN 7 ELSE 0 END), xor(CASE WHEN x3 & 4 > 0 THEN 3 ELSE 0 END, CASE WHEN x3 & 2 > 0 THEN 1 ELSE 0 END)) AS f FROM gray
        ), curved AS (
            SELECT *, list_sum(list_transform([0, 1, 2, 3, 4], lambda k: ((xor(x1, f) >> k) & 1) * (4 << 3 * k) + ((xor(x2, f) >> k) & 1) * (2 << 3 * k) + ((xor(x3, f) >> k) & 1) * (1 << 3 * k))) AS curve FROM flipped
        ), ranked AS (
            SELECT *, (row_number() OVER (ORDER BY curve, crc, size, doc_id NULLS FIRST, nth) - 1) AS rank, count(*) OVER () AS total FROM curved
        ), cut AS (
            SELECT *, rank * 24 // total AS shard FROM ranked
        )
        SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'rows' AS law, shard::INTEGER AS shard, rank - min(rank) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard FROM cut
    """,
}
