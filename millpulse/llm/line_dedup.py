"""Operator 1: repeated runs of lines, by a distributed suffix array over line ids.

Only DataFrame functions.  A document's sequence holds its lines that are not
blank.  Prefix doubling: the rank of a position is that of its first line among
all lines; ranks of twice as many lines are those of the pairs (rank here, rank
h places further).  Ranks follow the order of the keys: distinct keys are range
partitioned and sorted, and numbered by partition and place, so no total count
and no single task is needed.  Positions whose rank nobody shares are dropped
after each step; they have no longer common prefix with any other.  Two ranks
that overlap meet where the depth is no power of two.  The rank further on comes
from a window of one row, so a document of any length is sorted, never held.

At each depth the positions of one rank are an interval of the suffix array with
longest common prefixes of at least that many lines.  A repeated run counts if it
has ``min_lines`` lines, or fewer with ``min_words`` words together.  The first
of an interval in document order keeps its lines, those of all later ones are
deleted; consecutive later ones make up the maximal repeated runs.

Defined cases: null text stays null, with no lines.  Blank lines are never
deleted and do not interrupt a run.  Document order is by id (null first), then
by a hash of the text, then by place.  Rows with the same id and text are one
document: they get the same answer, and count once.  Other columns stay as they
are, whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, free_name, shuffled

MIN_LINES = 3
MIN_WORDS = 50
BLANK = r"\A\s*\z"


def _lines(text: Column) -> Column:
    """(i, line) of the lines that are not blank."""
    every = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("line")))
    return F.filter(every, lambda x: ~x["line"].rlike(BLANK))


def _ranked(keys: DataFrame, names: list[str], scratch: Scratch, name: str) -> DataFrame:
    """Distinct keys held by two positions or more, with a rank that follows their order."""
    shared = keys.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").select(*names)
    ordered = shared.repartitionByRange(*names).sortWithinPartitions(*names)
    return scratch.table(ordered.withColumn("rank", F.monotonically_increasing_id()), name)


def _words(line: Column) -> Column:
    return F.size(F.split(F.trim(line), r"\s+"))


def _doubled(ranks: DataFrame, step: int, scratch: Scratch, name: str) -> DataFrame:
    """(id, h, p, rank, before, through) for prefixes longer by ``step`` lines."""
    ahead = Window.partitionBy("id", "h").orderBy("p").rangeBetween(step, step)
    after = F.first(F.struct("rank", "through")).over(ahead)
    pairs = ranks.withColumn("after", after).where("after is not null").select("id", "h", "p", F.col("rank").alias("a"), "after.rank", "before", "after.through").withColumnRenamed("rank", "b")
    order = _ranked(pairs, ["a", "b"], scratch, f"{name}-order")
    return scratch.table(pairs.join(order, ["a", "b"]).select("id", "h", "p", "rank", "before", "through"), name)


def _later(ranks: DataFrame) -> DataFrame:
    """Positions that are not the first of their rank."""
    place = F.struct("id", "h", "p")
    first = ranks.groupBy("rank").agg(F.min(place).alias("first"))
    return ranks.join(first, "rank").where(~place.eqNullSafe(F.col("first"))).select("id", "h", "p")


def repeated_lines(docs: DataFrame, scratch: Scratch, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, h, gone): per document (id, h, text) the places of the lines to delete."""
    lines = docs.where("text is not null").select("id", "h", F.posexplode(_lines(F.col("text"))).alias("p", "x"))
    keyed = lines.select("id", "h", "p", F.xxhash64("x.line").alias("a"), F.hash("x.line").alias("b"), _words(F.col("x.line")).alias("words"))
    order = _ranked(keyed, ["a", "b"], scratch, "order")
    # a repeated window holds repeated lines only: running sums over those give its words
    shared = keyed.join(order, ["a", "b"]).select("id", "h", "p", "rank", "words").repartition("id", "h").distinct()
    through = F.sum("words").over(Window.partitionBy("id", "h").orderBy("p").rowsBetween(Window.unboundedPreceding, 0))
    shared = shared.withColumn("through", through).select("id", "h", "p", "rank", (F.col("through") - F.col("words")).alias("before"), "through")
    at = {1: scratch.table(shared, "lines")}
    gone = None
    for depth in range(1, min_lines + 1):
        if depth > 1:
            half = 1 << (depth - 1).bit_length() - 1  # the largest power of two below the depth
            at[depth] = _doubled(at[half], depth - half, scratch, f"depth-{depth}")
        runs = at[depth] if depth == min_lines else at[depth].where(F.col("through") - F.col("before") >= min_words)
        places = _later(runs).select("id", "h", F.explode(F.sequence(F.col("p"), F.col("p") + (depth - 1))).alias("p"))
        gone = places if gone is None else gone.union(places)
    return scratch.table(gone.groupBy("id", "h").agg(F.collect_set("p").alias("gone")), "gone")


def deduplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with ``text`` replaced, and a struct column ``_lines`` (total, removed).

    All columns of docs stay; the new one is the last (``_lines_`` where docs have a ``_lines``).
    """
    scratch = Scratch(docs.sparkSession, "lines")
    text = F.col(text_col)
    rest = F.struct(*[docs[c] for c in docs.columns if c != text_col])
    keyed = docs.select(rest.alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.split(text, "\n", -1).alias("lines"), F.transform(_lines(text), lambda x: x["i"]).alias("own"))
    gone = repeated_lines(docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("h")), scratch, min_lines, min_words)
    gone = gone.select(F.col("id").alias("gid"), F.col("h").alias("gh"), "gone")
    # the lines come out of the join as a column: places are looked up in it, not in the text again
    out = keyed.join(shuffled(gone), keyed["id"].eqNullSafe(gone["gid"]) & (keyed["h"] == gone["gh"]), "left")
    drop = F.transform("gone", lambda p: F.get("own", p))
    keep = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), drop)
    lines = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(keep, lambda i: F.get("lines", i)))
    kept = [F.array_join(lines, "\n").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    total, removed = (F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long") for c in ("own", "gone"))
    return out.select(*kept, F.struct(total.alias("total"), removed.alias("removed")).alias(free_name(docs, "_lines")))
