"""Operators over rows in a known order: numbering, neighbours and runs across rows.

A text file is read in parts (file, start of the split) by many tasks, and a sorted table
lies in ranges.  Order inside a part is the order of its rows; what must cross a border
goes through a table with one row per part: a prefix sum of counts (line numbers, ranks,
sentence numbers) or the last word of the parts before (adjacent pairs).  So text and
counts never pass through one task; the only windows without a partition run over the
parts' own rows.

``placed_lines`` stores what it read together with its place, and ``numbered`` stores the
sorted rows: both numbers would change if a later job cut the input into other parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions import text as T
from ledgerlens.functions.cleaning import safe_ratio
from ledgerlens.session import materialize

_PART = ["file", "doc_id", "part"]


# ---------------------------------------------------------------------------
# Places
# ---------------------------------------------------------------------------


def placed_lines(spark: SparkSession, path: str, words: Column | None = None) -> DataFrame:
    """The lines of text files with their places: (doc_id, file, part, seq, line).

    ``doc_id`` is the file's path, ``file`` the number in its name where that is a part of a
    written table (0 elsewhere; files are ordered by it, then by path), ``part`` the
    byte at which its split begins, and ``seq`` grows with the lines of a split.  Reads
    the files once and stores the lines (a job).  With ``words``, a word list made from
    ``line``, that list is stored instead of the line, so it is made once however many
    branches read it: (doc_id, file, part, seq, words).
    """
    name = F.col("_metadata.file_name")
    number = F.coalesce(F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long"), F.lit(0))
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("doc_id"), number.alias("file"), F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"),
    )
    if words is None:
        return materialize(lines, "lines")
    return materialize(lines.select("doc_id", "file", "part", "seq", words.alias("words")), "words")


def _in_order(whole: bool):
    """The order of parts: within each file, or (``whole``) over all files as one text."""
    return (Window.partitionBy() if whole else Window.partitionBy("doc_id")).orderBy(*_PART)


def _before(parts: DataFrame, amount: str, whole: bool) -> DataFrame:
    """``parts`` with ``before``: the sum of ``amount`` over the parts before (one row per part, stored)."""
    earlier = _in_order(whole).rowsBetween(Window.unboundedPreceding, -1)
    return materialize(parts.withColumn("before", F.coalesce(F.sum(amount).over(earlier), F.lit(0).cast("long"))), "parts")


def numbered_lines(placed: DataFrame, whole: bool = False) -> DataFrame:
    """(doc_id, line_no, line): lines numbered from 1 in each file, or over all files in order."""
    parts = placed.groupBy(*_PART).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    offsets = _before(parts, "n", whole).select("doc_id", "part", "first", "before")
    return placed.join(offsets, ["doc_id", "part"]).select("doc_id", (F.col("seq") - F.col("first") + F.col("before") + 1).alias("line_no"), "line")


def numbered(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its place from 1 in ``order``, for any number of rows (W4 over a full ranked list).

    Rows are dealt into ranges of the order and sorted there; the counts of the ranges
    before are added.  ``order`` should be unique, or ties fall in any order.  Stores the
    sorted rows (a job).
    """
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(ranged.select(F.struct("*").alias("row"), place.alias("seq")).withColumn("part", F.shiftright("seq", 33)), "ranked")
    parts = stored.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(F.lit(0).alias("file"), F.lit("").alias("doc_id"), "part", "n")
    offsets = _before(parts, "n", True).select("part", "before")
    inside = F.col("seq").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.join(offsets, "part").select("row.*", (inside + F.col("before") + 1).alias(name))


def read_ranked_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """The rows of ``sinks.write_ranked_csv`` with their ``rank`` in the written list.

    A row's rank is its line number over all parts (less the header's), so cells must not
    hold line breaks.
    """
    lines = numbered_lines(placed_lines(spark, path), whole=True)
    rank = F.col("line_no") - int(header)
    return lines.where(rank > 0).select(F.from_csv("line", schema, {"escape": '"', "nullValue": "\u0000"}).alias("row"), rank.alias("rank")).select("row.*", "rank")


# ---------------------------------------------------------------------------
# Neighbours across rows
# ---------------------------------------------------------------------------


def adjacent_pairs(rows: DataFrame, words: str = "words", whole: bool = False) -> DataFrame:
    """(w1, w2) of neighbouring words over all rows of a text in place order (W3 over lines).

    ``rows``: (doc_id, file, part, seq, <words>), a word list per line.  Pairs inside a line
    come from its list; pairs across lines from the last word of the line before, of the
    same part, that has words; and pairs across parts from a table with the first and
    last word of each part, so parts without words are skipped.  The lines' ends are
    shuffled once: a part's own come from the lines that have none before or after them.
    """
    inner = rows.select(F.explode_outer(T.adjacent_pairs(F.col(words))).alias("b")).where("b is not null").select("b.w1", "b.w2")
    ends = rows.where(F.size(words) > 0).select(*_PART, "seq", F.element_at(words, 1).alias("w_first"), F.element_at(words, -1).alias("w_last"))
    line = Window.partitionBy(*_PART).orderBy("seq")
    around = ends.withColumns({"w_before": F.lag("w_last").over(line), "w_after": F.lead("w_first").over(line)})
    lines = around.select(F.col("w_before").alias("w1"), F.col("w_first").alias("w2"))
    outer = around.where("w_before is null or w_after is null")
    borders = outer.groupBy(*_PART).agg(F.min_by("w_first", "seq").alias("w_first"), F.max_by("w_last", "seq").alias("w_last"))
    parts = borders.select(F.lag("w_last").over(_in_order(whole)).alias("w1"), F.col("w_first").alias("w2"))
    return inner.unionByName(lines.unionByName(parts).where("w1 is not null"))


def bigram_counts(rows: DataFrame, words: str = "words", whole: bool = False) -> DataFrame:
    """Occurrences per pair of neighbouring words, across lines."""
    return adjacent_pairs(rows, words, whole).groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------------------
# Sentences across rows
# ---------------------------------------------------------------------------


def _cut_lines(placed: DataFrame) -> DataFrame:
    """Lines cut at sentence ends: pieces, and how many sentences end in the line.

    The text is the lines joined by a space, so a line that ends with ``.``, ``!`` or ``?``
    ends a sentence there; any other last piece (empty after a final blank) goes on.
    """
    closed = F.substring("line", -1, 1).isin(".", "!", "?")
    cut = placed.select(*_PART, "seq", F.split("line", T.SENTENCE_BREAK).alias("pieces"), closed.alias("closed"))
    return cut.withColumn("ended", (F.size("pieces") - 1 + F.col("closed").cast("int")).cast("long"))


def _sentence_numbers(cut: DataFrame, whole: bool) -> DataFrame:
    """``cut`` with ``before``: sentences that have ended before the line, in its text."""
    totals = _before(cut.groupBy(*_PART).agg(F.sum("ended").alias("ended")), "ended", whole).select("doc_id", "part", "before")
    earlier = Window.partitionBy(*_PART).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    here = cut.withColumn("here", F.coalesce(F.sum("ended").over(earlier), F.lit(0).cast("long")))
    return here.join(totals, ["doc_id", "part"]).withColumn("before", F.col("here") + F.col("before")).drop("here")


def _text(whole: bool) -> Column:
    return F.lit("").alias("text_id") if whole else F.col("doc_id").alias("text_id")


def sentence_stats_of_lines(placed: DataFrame, whole: bool = False) -> DataFrame:
    """Sentences and words per sentence over lines, as of the lines joined by a space.

    Sentences that lie inside a line are counted there.  A line's first piece and an
    unended last one are counted by (text, sentence number), with words and a mark for
    text that is not blank; only these narrow rows are shuffled.
    """
    cut = _cut_lines(placed).withColumn("n", F.transform("pieces", lambda p: F.size(T.alpha_words(p))))
    k = F.size("pieces")
    inside = F.slice("n", 2, F.greatest(k - F.when(F.col("closed"), 1).otherwise(2), F.lit(0)))
    within = cut.select(F.explode_outer(inside).alias("n")).where("n is not null")
    some = lambda at: T.py_strip(F.element_at("pieces", at)) != ""
    edges = cut.select(*_PART, "seq", "ended", "closed", F.size("pieces").alias("k"),
                       F.element_at("n", 1).alias("n_first"), some(1).alias("some_first"),
                       F.element_at("n", -1).alias("n_last"), some(-1).alias("some_last"))
    known = _sentence_numbers(edges, whole)
    first = F.struct(F.col("before").alias("sentence"), F.col("n_first").alias("n"), F.col("some_first").alias("some"))
    last = F.struct((F.col("before") + F.col("k") - 1).alias("sentence"), F.col("n_last").alias("n"), F.col("some_last").alias("some"))
    both = F.when((F.col("k") > 1) & ~F.col("closed"), F.array(first, last)).otherwise(F.array(first))
    across = known.select(_text(whole), F.explode(both).alias("e")).groupBy("text_id", "e.sentence").agg(F.sum("e.n").alias("n"), F.max("e.some").alias("some")).where("some")
    return within.select(F.col("n").cast("long").alias("n")).unionByName(across.select("n")).agg(
        F.count(F.lit(1)).alias("sentences"),
        safe_ratio(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).alias("avg_words_per_sentence"),
        F.min("n").cast("bigint").alias("min_words"),
        F.max("n").cast("bigint").alias("max_words"),
    )


def sentences_of_lines(placed: DataFrame, whole: bool = False, first: int | None = None) -> DataFrame:
    """(text_id, n, sentence): the sentences of the lines joined by a space, numbered from 1.

    With ``first`` only the first so many of each text.  A sentence inside a line leaves
    its row as it is; pieces of one that crosses lines are put together by its number, so
    a group is one sentence.  ``text_id`` is the file, or empty where all files are one text.
    """
    known = _sentence_numbers(_cut_lines(placed), whole)
    if first is not None:
        known = known.where(F.col("before") < first)
    pieces = known.select(_text(whole), *_PART, "seq", "before", "closed", F.size("pieces").alias("k"), F.posexplode("pieces").alias("t", "piece"))
    pieces = pieces.withColumn("n", F.col("before") + F.col("t") + 1)
    if first is not None:
        pieces = pieces.where(F.col("n") <= first)
    alone = (F.col("t") > 0) & ((F.col("t") < F.col("k") - 1) | F.col("closed"))
    joined = pieces.where(~alone).groupBy("text_id", "n").agg(F.sort_array(F.collect_list(F.struct(*_PART, "seq", "t", "piece"))).alias("parts"))
    joined = joined.select("text_id", "n", T.py_strip(F.array_join(F.transform("parts", lambda p: p["piece"]), " ")).alias("sentence"))
    return pieces.where(alone).select("text_id", "n", F.col("piece").alias("sentence")).unionByName(joined.where("sentence <> ''"))
