"""Text analytics over a document collection ``(doc_id, text)``.

The reference analyses one file at a time, partly on the driver after a
``collect()``.  Here a document is one row and every statistic is a
distributed aggregate:

* per-document sequences (lines, sentences, token lists, bigrams) are arrays
  built inside the row - text order is kept without a shuffle or a sort, and
  sentences and bigrams never cross a document boundary (D9);
* corpus-wide counts explode those arrays and aggregate with map-side partial
  aggregation, so a hot word (``the``) costs one partial row per task;
* top-k lists are ``TakeOrderedAndProject`` with an explicit tie-break
  (count desc, then key asc) instead of first-seen order (D10).

No function caches or uses a Python UDF; only ``top_counts_sketched`` runs jobs and
collects (bucket numbers, a bounded number).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import text as T
from ledgerlens.functions.cleaning import safe_ratio
from ledgerlens.session import materialize

# ---------------------------------------------------------------------------
# Exploding arrays
# ---------------------------------------------------------------------------
#
# A plain ``explode`` of a computed array makes the optimizer infer a
# ``size(array) > 0`` filter and push it below the projection (even below a
# repartition), so the whole tokenizer would run twice.  The ``_outer``
# generators are exempt; the NULL row they emit for an empty array is
# filtered right after, which gives exactly the rows of ``explode``.


def explode_values(df: DataFrame, array: Column | str, name: str, *keep: str) -> DataFrame:
    """One row per array element (``explode`` without the inferred pre-filter)."""
    arr = F.col(array) if isinstance(array, str) else array
    return df.select(*keep, F.explode_outer(arr).alias(name)).filter(F.col(name).isNotNull())


def explode_positions(df: DataFrame, array_col: str, value_name: str) -> DataFrame:
    """``(doc_id, pos, value)`` from an array column, ``pos`` counted from 1."""
    return (
        df.select("doc_id", F.posexplode_outer(array_col).alias("p", value_name))
        .filter(F.col("p").isNotNull())
        .select("doc_id", (F.col("p") + 1).cast("bigint").alias("pos"), value_name)
    )


# ---------------------------------------------------------------------------
# Sequences per document
# ---------------------------------------------------------------------------


def lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per line: ``(doc_id, line_no, line)``, ``line_no`` from 1."""
    arr = docs.select("doc_id", T.lines_of(F.col(text_col)).alias("lines"))
    return explode_positions(arr, "lines", "line").withColumnRenamed("pos", "line_no")


def sentence_lists(docs: DataFrame, mode: str = "dot", text_col: str = "text") -> DataFrame:
    """``(doc_id, sentences)``: the sentence array of each document.

    ``dot``: every line split at each dot, blank pieces dropped.
    ``punct``: lines joined by a space, split after ``.!?`` + whitespace, stripped.
    ``punct_raw``: like ``punct`` on the unjoined text (the web app's variant).
    """
    text = F.col(text_col)
    if mode == "dot":
        arr = T.dot_sentences(text)
    elif mode == "punct":
        arr = T.punct_sentences(T.joined_lines(text))
    elif mode == "punct_raw":
        arr = T.punct_sentences(text)
    else:
        raise ValueError(f"unknown sentence mode {mode!r}")
    return docs.select("doc_id", arr.alias("sentences"))


def sentences(docs: DataFrame, mode: str = "dot", text_col: str = "text") -> DataFrame:
    """One row per sentence: ``(doc_id, pos, sentence)``, ``pos`` from 1."""
    return explode_positions(sentence_lists(docs, mode, text_col), "sentences", "sentence")


def tokens(docs: DataFrame, mode: str = "strip", unicode: bool = False, lower: bool = False,
           text_col: str = "text") -> DataFrame:
    """``(doc_id, words)``: the token array of each document.

    ``strip``: punctuation to spaces, lower case, whitespace split (A15).
    ``alpha``: runs of ``[A-Za-z']`` (the same on the text or its space-joined
    lines), case kept unless ``lower`` (A18-A20).
    ``whitespace``: lower case, whitespace split, punctuation kept.
    """
    text = F.col(text_col)
    if mode == "strip":
        arr = T.strip_words(text, unicode)
    elif mode == "alpha":
        arr = T.alpha_words(text, lower=lower)
    elif mode == "whitespace":
        arr = T.whitespace_words(text)
    else:
        raise ValueError(f"unknown token mode {mode!r}")
    return docs.select("doc_id", arr.alias("words"))


def remove_stopwords(token_lists: DataFrame, words=T.NOTEBOOK_STOPWORDS, min_len: int = 2) -> DataFrame:
    """Drop stopwords and tokens shorter than ``min_len``, keeping order."""
    return token_lists.select("doc_id", T.without_stopwords(F.col("words"), words, min_len).alias("words"))


def explode_words(token_lists: DataFrame) -> DataFrame:
    """``(doc_id, pos, word)``."""
    return explode_positions(token_lists, "words", "word")


def exclude_words(word_rows: DataFrame, stopwords: DataFrame, col: str = "word") -> DataFrame:
    """Word rows minus a stopword table, by left anti join on the word.

    For stopword lists supplied as data (any size): the planner broadcasts the
    list when it is under the broadcast threshold and shuffles otherwise.
    Fixed lists are better applied in-row with ``remove_stopwords``.
    """
    stop = stopwords.select(F.col(stopwords.columns[0]).alias(col)).distinct()
    return word_rows.join(stop, col, "left_anti")


def first_in_text_order(rows_: DataFrame, n: int, pos_col: str = "pos") -> DataFrame:
    """The first ``n`` rows of the collection in text order (doc, then position).

    A ``TakeOrderedAndProject``: each task keeps its first ``n``, then ``n``
    rows per task are merged.
    """
    return rows_.orderBy(F.col("doc_id").asc(), F.col(pos_col).asc()).limit(n)


# ---------------------------------------------------------------------------
# Corpus-wide counts
# ---------------------------------------------------------------------------


def word_counts(token_lists: DataFrame, word_name: str = "word", count_name: str = "count") -> DataFrame:
    """Occurrences per word over all documents."""
    return explode_values(token_lists, "words", word_name).groupBy(word_name).agg(
        F.count(F.lit(1)).alias(count_name))


def bigram_counts(token_lists: DataFrame) -> DataFrame:
    """Occurrences per adjacent pair within a document (W3 + A16)."""
    pairs = explode_values(token_lists, T.adjacent_pairs(F.col("words")), "b")
    return pairs.groupBy(F.col("b.w1").alias("w1"), F.col("b.w2").alias("w2")).agg(
        F.count(F.lit(1)).alias("count"))


def ranked(counts: DataFrame, keys: list[str], count_name: str = "count") -> DataFrame:
    """The whole count list, most frequent first, ties by key (the exported ranking, K5)."""
    return counts.orderBy(F.col(count_name).desc(), *[F.col(k).asc() for k in keys])


def top_counts(counts: DataFrame, n: int, keys: list[str], count_name: str = "count") -> DataFrame:
    """The ``n`` most frequent keys; ties by key ascending."""
    return counts.orderBy(F.col(count_name).desc(), *[F.col(k).asc() for k in keys]).limit(n)


SKETCH_BUCKETS = 1 << 16


def top_counts_sketched(token_lists: DataFrame, n: int, buckets: int = SKETCH_BUCKETS) -> DataFrame:
    """``top_counts(word_counts(...), n, ["word"])`` without shuffling the vocabulary.

    A sketch first: words are hashed to buckets and only bucket totals are shuffled (at most
    ``buckets`` rows a task).  A total is an upper bound for every word of its bucket.  The
    words of the heaviest buckets are counted exactly; the n-th of these counts is a
    lower bound for the n-th largest of all, so every word of the answer lies in a
    bucket whose total reaches it.  If all those buckets have been counted the answer is
    proved; else they are counted too, and where they are most of the buckets, or fewer
    than ``n`` words were found, all words are counted.  Runs jobs; the driver gets bucket
    numbers, at most a quarter of ``buckets``.
    """
    words = explode_values(token_lists, "words", "word").withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)))
    totals = materialize(words.groupBy("bucket").agg(F.count(F.lit(1)).alias("total")), "sketch")
    exact = lambda chosen: words.where(F.col("bucket").isin(chosen)).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    heavy = totals.orderBy(F.col("total").desc(), "bucket").limit(4 * n).select("bucket", "total").collect()
    if not heavy:
        return top_counts(words.groupBy("word").agg(F.count(F.lit(1)).alias("count")), n, ["word"])
    found = materialize(top_counts(exact([r.bucket for r in heavy]), n, ["word"]), "heavy")
    bound = found.agg(F.min("count").alias("least"), F.count(F.lit(1)).alias("n")).first()
    needed = totals.where(F.col("total") >= (bound.least if bound.n == n else 0))
    if bound.n == n and heavy[-1].total < bound.least:
        return top_counts(found, n, ["word"])
    many = needed.count()
    if many <= buckets // 4 and bound.n == n:
        return top_counts(exact([r.bucket for r in needed.select("bucket").collect()]), n, ["word"])
    return top_counts(words.groupBy("word").agg(F.count(F.lit(1)).alias("count")), n, ["word"])


def length_histogram(token_lists: DataFrame, below: int | None = None) -> DataFrame:
    """Words per length, bin width 1 (A17); lengths ``< below`` only when given."""
    lengths = explode_values(token_lists, "words", "w").select(
        F.length("w").cast("bigint").alias("length"))
    if below is not None:
        lengths = lengths.filter(F.col("length") < below)
    return lengths.groupBy("length").agg(F.count(F.lit(1)).alias("count"))


def longest_words(token_lists: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` longest distinct words; ties by word ascending."""
    distinct = explode_values(token_lists, "words", "word").distinct()
    return (
        distinct.select("word", F.length("word").cast("bigint").alias("length"))
        .orderBy(F.col("length").desc(), F.col("word").asc()).limit(n)
    )


def token_totals(token_lists: DataFrame) -> DataFrame:
    """Total tokens and distinct words, one row.

    Distinct words are grouped first (a shuffle by word with partial
    aggregation), then counted - never gathered into one task.
    """
    per_word = word_counts(token_lists)
    return per_word.agg(
        F.sum("count").cast("bigint").alias("total_tokens"),
        F.count(F.lit(1)).alias("unique_words"),
    )


def kept_vs_raw(raw_lists: DataFrame, stopwords=T.NOTEBOOK_STOPWORDS, min_len: int = 2) -> DataFrame:
    """Tokens kept after stopword removal vs all tokens, one row."""
    kept = T.without_stopwords(F.col("words"), stopwords, min_len)
    return raw_lists.agg(
        F.sum(F.size(kept)).cast("bigint").alias("kept_tokens"),
        F.sum(F.size("words")).cast("bigint").alias("raw_tokens"),
    )


# ---------------------------------------------------------------------------
# Statistics
# ---------------------------------------------------------------------------


def corpus_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per document: characters, lines, words, distinct words, mean word length.

    The text is the lines joined by one space; words are ``[A-Za-z']+`` runs;
    distinct words are counted case-insensitively; the mean is 0-safe.  The
    word array is built in its own projection: expressions with lambdas are
    not shared by common-subexpression elimination, so every further use
    reads the column instead of re-running the regex.
    """
    text = F.col(text_col)
    step = docs.select(
        "doc_id",
        T.joined_length(text).alias("characters"),
        T.line_count(text).alias("lines"),
        T.alpha_words(text).alias("_w"),
    )
    words = F.col("_w")
    total_len = F.aggregate(words, F.lit(0).cast("bigint"), lambda acc, w: acc + F.length(w))
    return step.select(
        "doc_id", "characters", "lines",
        F.size(words).cast("bigint").alias("words"),
        F.size(F.array_distinct(F.transform(words, F.lower))).cast("bigint").alias("unique_words"),
        safe_ratio(total_len, F.size(words)).alias("avg_word_length"),
    )


def corpus_totals(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same statistics over the whole collection, one row.

    One chain, tokenizing once: each document's distinct lower-cased words are
    exploded, the document's own statistics ride on its first row, the rows
    are aggregated by word (partial + final, so hot words cost nothing), and
    one global aggregate counts the words and adds the statistics.
    """
    text = F.col(text_col)
    step = docs.select(
        T.joined_length(text).alias("characters"),
        T.line_count(text).alias("lines"),
        T.alpha_words(text, lower=True).alias("_w"),
    )
    words = F.col("_w")
    per_doc = step.select(
        "characters", "lines",
        F.size(words).cast("bigint").alias("words"),
        F.aggregate(words, F.lit(0).cast("bigint"), lambda acc, w: acc + F.length(w)).alias("letters"),
        F.array_distinct(words).alias("distinct_words"),
    )
    stats = ("characters", "lines", "words", "letters")
    first = F.col("p").isNull() | (F.col("p") == 0)
    rows = per_doc.select(F.posexplode_outer("distinct_words").alias("p", "word"), *stats).select(
        "word", F.when(first, 1).otherwise(0).alias("documents"),
        *[F.when(first, F.col(c)).otherwise(0).alias(c) for c in stats])
    by_word = rows.groupBy("word").agg(
        *[F.sum(c).alias(c) for c in ("documents", *stats)])
    return by_word.agg(
        F.sum("documents").cast("bigint").alias("documents"),
        F.sum("characters").cast("bigint").alias("characters"),
        F.sum("lines").cast("bigint").alias("lines"),
        F.sum("words").cast("bigint").alias("words"),
        F.count("word").alias("unique_words"),
        safe_ratio(F.coalesce(F.sum("letters"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0)))
        .alias("avg_word_length"),
    )


def sentence_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Sentences and words per sentence (count, mean, min, max) over all documents."""
    per_sentence = sentences(docs, "punct", text_col).select(
        F.size(T.alpha_words(F.col("sentence"))).alias("n"))
    return per_sentence.agg(
        F.count(F.lit(1)).alias("sentences"),
        safe_ratio(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).alias("avg_words_per_sentence"),
        F.min("n").cast("bigint").alias("min_words"),
        F.max("n").cast("bigint").alias("max_words"),
    )


def first_sentences(docs: DataFrame, n: int = 3, mode: str = "punct", text_col: str = "text",
                    term: str | None = None) -> DataFrame:
    """The first ``n`` sentences of every document, numbered from 1 (O8 + W4); of those
    that contain ``term`` where one is given (F7)."""
    lists = sentence_lists(docs, mode, text_col)
    if term is not None:
        lists = lists.withColumn("sentences", F.filter("sentences", lambda s: s.contains(term)))
    firsts = lists.select("doc_id", F.slice("sentences", 1, n).alias("sentences"))
    return explode_positions(firsts, "sentences", "sentence").withColumnRenamed("pos", "n")


def containing(sentence_rows: DataFrame, term: str, col: str = "sentence") -> DataFrame:
    """Sentences that contain ``term`` (case-sensitive substring)."""
    return sentence_rows.filter(F.col(col).contains(term))


def web_text_stats(docs: DataFrame, term: str, text_col: str = "text") -> DataFrame:
    """Per document: characters, Unicode words, sentences, sentences with ``term``."""
    text = F.col(text_col)
    step = docs.select(
        "doc_id",
        F.length(text).cast("bigint").alias("total_characters"),
        F.size(T.strip_words(text, unicode=True)).cast("bigint").alias("total_words"),
        T.punct_sentences(text).alias("_s"),
    )
    return step.select(
        "doc_id", "total_characters", "total_words",
        F.size("_s").cast("bigint").alias("total_sentences"),
        F.size(F.filter("_s", lambda s: s.contains(term))).cast("bigint").alias("term_sentences"),
    )
