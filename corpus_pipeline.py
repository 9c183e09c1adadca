"""Corpus pipeline: documents -> identified, deduplicated, decontaminated, packed.

Each stage takes the documents that the stage before kept, as written and read
again, and returns the columns of documents; the last one returns the pieces of
packed sequences (columns of ``op3_best_fit_packing``).  Where a stage changes a
text, ``n_chars`` follows.  Stages handle null and empty texts, repeated rows and
empty tables as their operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.llm.common import Scratch, documents, table
from millpulse.llm.decontaminate import cut_contamination
from millpulse.llm.language_id import keep_identified
from millpulse.llm.line_dedup import deduplicate_lines
from millpulse.llm.minhash_dedup import keep_one
from millpulse.llm.packing import pack_documents


#: The corpus takes pairs with 5-word shingle similarity of 0.80 (the op2 query: 0.85);
#: with 2 x 14 sub-keys of 3 min-hashes 0.9999 of the pairs at 0.80 meet.
NEAR_PART, NEAR_WHOLE, NEAR_TABLES = 80, 100, 14


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: texts in none of the corpus's languages go; the others get the label found."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: later copies of line runs go, and documents made of nothing else."""
    out = deduplicate_lines(docs)
    lines = out.columns[-1]
    return _counted(out.where(f"`{lines}`.removed = 0 or `{lines}`.removed < `{lines}`.total").drop(lines))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each group of near copies (similarity 0.8 and more) stays."""
    return keep_one(docs, part=NEAR_PART, whole=NEAR_WHOLE, m=NEAR_TABLES)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: passages of benchmark items are cut out."""
    return _counted(cut_contamination(docs, table(spark, sf_dir, "benchmark")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: what is left, packed into sequences."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: SQL expresses neither the language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
