"""Operator 8: language identification, words first with back-off to character n-grams.

Model: per language the log frequencies of words and of character n-grams (n =
4..1, words padded with ``_``), smoothed by adding ``ALPHA``.  It knows those that
occur in two documents or more, so that no document vouches for itself.  A known word scores its own log frequencies; an unseen word scores
the mean log frequency of its known 4-grams, without any its 3-grams, and so on
down to single characters; a word with none known says nothing.  A text's
language is the one with the highest sum over all its words.  The score is the
softmax of the sums divided by the square root of the number of words
(neighbouring words are not independent evidence).

``coverage`` tells whether a text is in any of the languages at all: the mean over
its distinct words of 1 for a known word, else the share of the word's 4-grams
(3-grams of one letter) that are known.  ``PRIOR`` further words count as known, so
that a text of a few strange words is not judged by them.

Bounds: the model is fitted on at most ``fit_docs`` documents of each language,
those with the least hash of id and text (a uniform sample that does not depend
on partitioning); nothing else is cut.  Hashes below a threshold set by the number of
the language's documents come first, then the least of those few, so that no task
reads all documents of a language.  Words and n-grams are 64-bit hashes: the
model takes 8 bytes a token and 4 a token and language, is collected and
broadcast, and is bounded by the sample.  Predictions read every whole text in
one narrow pass, block by block on arrays.

Defined cases: null text, empty text and text without letters give ``und`` with
score 0 and coverage 0; so does every text if there is nothing to learn from.  What a single document holds is not known.  Rows
without a language, and rows that are held out, are not learned from.  A null id
counts as held out (the checksum of the empty string is 0).  Repeated rows get equal
answers and are learned from once.  Ties go to the first language in order.  Letters are
lower-cased one by one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import textops as tx
from .common import Scratch, spread

FIT_DOCS = 4000
ORDERS = (4, 3, 2, 1)
ALPHA = 0.1
PRIOR = 5
#: Texts that are worked on at once; the arrays take some 80 times that.
BLOCK_BYTES = 1 << 17
UNKNOWN = "und"
#: A filter keeps texts whose language has at least this score, and of whose words at least this share is covered.
LEAST_SCORE = 0.3
LEAST_COVERAGE = 0.5


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter, and its lower case."""
    is_letter = np.zeros(sys.maxunicode + 1, dtype=bool)
    lower = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            is_letter[i] = True
            lower[i] = ord(c.lower()[0])
    return is_letter, lower


_tables: list[tuple[np.ndarray, np.ndarray]] = []


@dataclass
class Words:
    """The words of a block of texts: hashes of their lower-cased code points, and where they lie."""

    values: np.ndarray  # of the code points
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # each text's first word, and the number of words

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


_PAD = tx.mix(np.array([ord("_") + 1], dtype=np.uint64))[0]


def words_of(data: np.ndarray, offs: np.ndarray) -> Words:
    if not _tables:
        _tables.append(_letters())
    is_letter, lower = _tables[0]
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    begins = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    s, e, first = tx.word_spans(codes, begins[offs], is_letter)
    return Words(tx.mix(lower[codes].astype(np.uint64) + np.uint64(1)), s, e, first)


def grams(words: Words, which: np.ndarray, orders: tuple[int, ...] = ORDERS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, word, hash) of the n-grams of words ``which``: places in ``which``, in order, and the grams' hashes."""
    s, length = words.start[which], words.end[which] - words.start[which]
    row, at = spread(length + 2)
    inner = (at > 0) & (at <= length[row])
    padded = np.full(len(row), _PAD)
    padded[inner] = words.values[(s[row] + at - 1)[inner]]
    rolling = tx.Rolling(padded)
    begin = np.concatenate(([0], np.cumsum(length + 2)[:-1])) if len(length) else length
    for n in orders:
        edge = 1 if n == 1 else 0  # single characters come without padding
        word, k = spread(np.maximum(length + 2 - 2 * edge - n + 1, 0))
        a = begin[word] + edge + k
        yield n, word, rolling.slices(a, a + n)


@dataclass
class Model:
    languages: list[str]
    tokens: dict[int, np.ndarray]  # sorted hashes: of words (0) and of n-grams (n)
    vectors: dict[int, np.ndarray]  # their log frequencies

    def find(self, kind: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, known) of hashes among the tokens of a kind."""
        have = self.tokens[kind]
        if not len(have):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        place = np.minimum(np.searchsorted(have, hashes), len(have) - 1)
        return place, have[place] == hashes


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _grouped(tokens: np.ndarray, of: np.ndarray, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """(tokens, sum of c, least lo, greatest hi) of rows that belong to token ``of``."""
    order = np.argsort(of, kind="stable")
    at = np.searchsorted(of[order], np.arange(len(tokens)))
    if not len(tokens):
        return tokens, c, lo, hi
    return tokens, np.add.reduceat(c[order], at), np.minimum.reduceat(lo[order], at), np.maximum.reduceat(hi[order], at)


def _count_tokens(docs: DataFrame) -> DataFrame:
    """(lang, kind, token, c, lo, hi): words and n-grams of docs (lang, text, order), counted a block at a time.

    ``lo`` and ``hi`` are the least and the greatest ``order`` of a document with the token.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            number = langs.indices.to_numpy()
            for i, data, offs in tx.text_blocks(batch.column(1), BLOCK_BYTES):
                words = words_of(data, offs)
                hashes = tx.Rolling(words.values).slices(words.start, words.end)
                of = number[i : i + len(offs) - 1][words.text]
                doc = batch.column(2).to_numpy()[i : i + len(offs) - 1][words.text]
                for lang in np.unique(of):
                    mine = np.flatnonzero(of == lang)
                    h, at, back = np.unique(hashes[mine], return_index=True, return_inverse=True)
                    found = [(0, *_grouped(h, back, np.ones(len(mine), np.int64), doc[mine], doc[mine]))]
                    _, _, c, lo, hi = found[0]
                    for n, word, g in grams(words, mine[at]):
                        g, back = np.unique(g, return_inverse=True)
                        found.append((n, *_grouped(g, back, c[word], lo[word], hi[word])))
                    for kind, h, *sums in found:
                        name = pa.array([langs.dictionary[int(lang)].as_py()] * len(h), pa.string())
                        yield pa.RecordBatch.from_arrays([name, pa.array(np.full(len(h), kind, np.int32)), pa.array(h.view(np.int64)), *map(pa.array, sums)], names=["lang", "kind", "token", "c", "lo", "hi"])

    return docs.select("lang", "text", "order").mapInArrow(run, "lang string, kind int, token long, c long, lo long, hi long")


def _sample(docs: DataFrame, fit_docs: int, scratch: Scratch) -> DataFrame:
    """Distinct docs (lang, text, order) with the least hashes, at most ``fit_docs`` a language."""
    docs = docs.where("lang is not null and text is not null").withColumn("order", F.xxhash64("id", "text"))
    # twice the share wanted, counted on all rows; the hash as a number from 0 to 1
    share = docs.groupBy("lang").agg(F.count("*").alias("n")).select("lang", ((2.0 * fit_docs + 100) / F.col("n")).alias("share"))
    share = scratch.table(share, "share")
    place = F.col("order").cast("double") / 2.0**64 + 0.5
    few = docs.join(share, "lang").where(place <= F.col("share")).groupBy("lang", "order").agg(F.first("text").alias("text"))
    few = scratch.table(few, "few")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    cut = few.select("lang", "order", rank.alias("r")).where(F.col("r") <= fit_docs).groupBy("lang").agg(F.max("order").alias("cut"))
    return few.join(cut, "lang").where(F.col("order") <= F.col("cut")).select("lang", "text", "order")


def _numbers(langs: pa.Array, number: dict[str, int]) -> np.ndarray:
    coded = langs.dictionary_encode()
    return np.array([number[x] for x in coded.dictionary.to_pylist()], dtype=np.int64)[coded.indices.to_numpy()]


def fit(docs: DataFrame, scratch: Scratch, fit_docs: int = FIT_DOCS) -> Model:
    """A model of docs (id, text, lang), all of which may be learned from."""
    counts = _count_tokens(_sample(docs, fit_docs, scratch)).groupBy("lang", "kind", "token").agg(F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    counts = scratch.table(counts, "counts")
    whole = {(r["lang"], r["kind"]): r["c"] for r in counts.groupBy("lang", "kind").agg(F.sum("c").alias("c")).collect()}
    languages = sorted({lang for lang, _ in whole})
    number = {x: i for i, x in enumerate(languages)}
    known = counts.groupBy("kind", "token").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("kind", "token")
    rows = counts.join(known, ["kind", "token"], "left_semi").select("lang", "kind", "token", "c").toArrow()
    which = np.concatenate([_numbers(chunk, number) for chunk in rows.column("lang").chunks] or [np.zeros(0, np.int64)])
    tokens, vectors = {}, {}
    kinds = rows.column("kind").to_numpy()
    for kind in (0, *ORDERS):
        mine = kinds == kind
        have, at = np.unique(rows.column("token").to_numpy()[mine].view(np.uint64), return_inverse=True)
        seen = np.zeros((len(have), len(languages)))
        seen[at, which[mine]] = rows.column("c").to_numpy()[mine]
        total = np.array([whole.get((x, kind), 0) for x in languages], dtype=float)
        tokens[kind], vectors[kind] = have, np.log((seen + ALPHA) / (total + ALPHA * (len(have) + 1))).astype(np.float32)
    return Model(languages, tokens, vectors)


def score(model: Model, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language, score, coverage) of each text; language -1 for texts without words."""
    texts = len(words.first) - 1
    many = np.diff(words.first)
    if not len(words.start) or not model.languages:
        return np.full(texts, -1), np.zeros(texts), np.zeros(texts)
    h, at, back = np.unique(tx.Rolling(words.values).slices(words.start, words.end), return_index=True, return_inverse=True)
    vectors, covered = np.zeros((len(h), len(model.languages))), np.ones(len(h))
    place, known = model.find(0, h)
    vectors[known] = model.vectors[0][place[known]]
    left = np.flatnonzero(~known)
    unseen = left
    one = words.end[at] - words.start[at] == 1
    for n in ORDERS:
        if not len(left):
            break
        ((_, word, g),) = grams(words, at[left], (n,))
        place, hit = model.find(n, g)
        hits = np.bincount(word[hit], minlength=len(left))
        for k in range(len(model.languages)):
            vectors[left, k] = np.bincount(word[hit], weights=model.vectors[n][place[hit], k], minlength=len(left)) / np.maximum(hits, 1)
        if n == 4 or n == 3:
            these = np.ones(len(left), bool) if n == 4 else one[left]
            covered[left[these]] = (hits / np.maximum(np.bincount(word, minlength=len(left)), 1))[these]
        left = left[hits == 0]
    text = words.text
    total = np.stack([np.bincount(text, weights=vectors[back, k], minlength=texts) for k in range(len(model.languages))], axis=1)
    best = np.argmax(total, axis=1)
    odds = np.exp((total - total[np.arange(texts), best][:, None]) / np.sqrt(np.maximum(many, 1))[:, None])
    owner, word = np.divmod(np.unique(text * len(h) + back), len(h))
    coverage = (np.bincount(owner, weights=covered[word], minlength=texts) + PRIOR) / (np.bincount(owner, minlength=texts) + PRIOR)
    some = many > 0
    return np.where(some, best, -1), np.where(some, 1 / odds.sum(axis=1), 0.0), np.where(some, coverage, 0.0)


def _names(model: Model, best: np.ndarray) -> pa.Array:
    return pa.array([*model.languages, UNKNOWN], pa.string()).take(pa.array(np.where(best < 0, len(model.languages), best)))


def predictions(model: Model, texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(language, score, coverage) of a column of texts."""
    parts = [score(model, words_of(data, offs)) for _, data, offs in tx.text_blocks(texts, BLOCK_BYTES)]
    best, scores, coverage = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, int), np.zeros(0), np.zeros(0))
    return _names(model, best), pa.array(scores), pa.array(coverage)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = LEAST_SCORE, least_coverage: float = LEAST_COVERAGE, fit_docs: int = FIT_DOCS) -> DataFrame:
    """The rows of docs, all columns, that are in one of the languages of docs.

    Texts without letters, with a score below ``least`` or with a coverage below
    ``least_coverage`` (in none of the languages learned) go.  Of those that stay the
    language becomes the one found, whatever was given.
    """
    spark = docs.sparkSession
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(~held_out(F.col("id")))
    shared = spark.sparkContext.broadcast(fit(known, Scratch(spark, "language"), fit_docs))
    text_at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, offs in tx.text_blocks(batch.column(text_at), BLOCK_BYTES):
                best, scores, coverage = score(shared.value, words_of(data, offs))
                columns = list(batch.slice(i, len(best)).columns)
                columns[lang_at] = _names(shared.value, best).cast(columns[lang_at].type)
                stays = (best >= 0) & (scores >= least) & (coverage >= least_coverage)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(stays))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_docs: int = FIT_DOCS) -> DataFrame:
    """Per row: id, held_out, lang_pred, score, coverage."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), held_out(F.col(id_col)).alias("held"))
    shared = spark.sparkContext.broadcast(fit(docs.where(~F.col("held")), Scratch(spark, "language"), fit_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *predictions(shared.value, batch.column(2))], names=["id", "held", "lang_pred", "score", "coverage"])

    schema = T.StructType([docs.schema["id"], T.StructField("held", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("coverage", T.DoubleType())])
    out = docs.select("id", "held", "text").mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), F.col("held").alias("held_out"), "lang_pred", "score", "coverage")
