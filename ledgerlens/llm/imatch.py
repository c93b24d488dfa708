"""I-Match fingerprints with randomised lexicon subsets.

A document's terms are its distinct words.  Terms whose inverse document frequency lies
in a band are kept: neither those that most documents have nor those of one document
only.  The distinct kept terms are sorted and hashed over the whole lexicon and over
``BROAD`` random subsets of it, each with three quarters of the terms, so every term is in some
hash: documents of different kept sets differ in the first one, and documents that
differ in a term or two agree on a broad subset (``matching``).

For a finer measure the lexicon is also divided at random into ``2**level`` small subsets;
for each of ``SUBSETS`` of them the document's kept terms in it are sorted and hashed.  Two
documents agree on a subset if they have the same kept terms in it, so the share of
agreeing subsets tells how alike they are.  Only documents that agree on the whole
lexicon have likeness 1.

The level follows the number of kept terms, so that a subset holds one of them at most on average;
a fingerprint has its own level and all higher ones until no subset is filled, so that any two
have a common level.  Likeness is taken at the higher of both own levels and, if these are
the same, at the next too (the better counts).  Subsets that are empty in both do not count.

Document frequencies are counted over all documents by the 64-bit hash of the term.  A term
of one document only is known with that document, so each document is given its own such
terms; terms that most documents have are few whatever the number of documents (at most a
document's mean number of terms over ``MOST_SHARE``) and every task gets them.  All other terms of
a document are in the band.  Everything is DataFrame expressions.

Definitions: null text is empty; documents without terms have an empty fingerprint, which
is like nothing but another empty one (1.0); if no term is in the band all terms count;
repeated rows are fingerprinted each; null ids come first in id order; of columns named
like the result column the new one stays, all others are carried as they are; a very long
text is one row, whose distinct terms are one array in a task; empty tables give empty
results.  Rows are named by id and text, never by their place in a scan, which
changes with the number of executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.llm import query
from ledgerlens.llm.tables import stored

#: Kept terms are in at least two documents and in at most this share of them.
MOST_SHARE = 0.25
#: Subsets hashed per level; the lowest level has as many in all.
SUBSETS = 32
#: Broad subsets hashed besides the whole lexicon, and the bits of a term's hash that choose them.
BROAD, BROAD_BITS = 4, 40
LOWEST, HIGHEST = 5, 24

SEPARATOR = r"[\x20\x09-\x0D]+"


def term_hashes(text: Column) -> Column:
    """The distinct words of a text as 64-bit hashes."""
    words = F.split(F.coalesce(text, F.lit("")), SEPARATOR)
    blank = F.xxhash64(F.lit(""))  # before the first and after the last separator
    return F.array_remove(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))), blank)


def term_counts(docs: DataFrame, at: list[str], text_col: str = "text") -> DataFrame:
    """One row per term: ``docs``, its document frequency, and if that is one the document's ``at`` columns."""
    pairs = docs.select(*at, F.explode_outer(term_hashes(F.col(text_col))).alias("term")).where("term is not null")
    counts = pairs.groupBy("term").agg(F.count(F.lit(1)).alias("docs"), *[F.min(c).alias(c) for c in at])
    return counts.select("term", "docs", *[F.when(F.col("docs") == 1, F.col(c)).alias(c) for c in at])


def in_band(counts: DataFrame, docs: DataFrame, most_share: float = MOST_SHARE) -> DataFrame:
    """``counts`` with ``band``: -1 for terms of one document only, 0 in the band, 1 for terms of too many."""
    most = F.greatest(docs.agg(F.count(F.lit(1)).alias("n")).scalar() * F.lit(most_share), F.lit(2.0))
    return counts.withColumn("band", F.when(F.col("docs") < 2, -1).when(F.col("docs") <= most, 0).otherwise(1)).drop("docs")


def common_terms(terms: DataFrame) -> DataFrame:
    """One row: ``common``, the terms that too many documents have."""
    return terms.where("band = 1").agg(F.array_sort(F.collect_list("term")).alias("common"))


def _number(term: Column) -> Column:
    return term.bitwiseAND(F.lit(SUBSETS - 1))


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once: the optimizer may copy a column into a lambda that uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _level(size: Column) -> Column:
    return F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), F.floor(F.log2(F.greatest(size, F.lit(1)))) + 1)).cast("int")


def _sampled(terms: Column, level: Column) -> Column:
    """The terms of the hashed subsets at the level, in order: few of all."""
    one = F.lit(1).cast("long")
    mask = F.call_function("shiftleft", one, level) - one
    return _let(mask, lambda m: F.array_sort(F.filter(terms, lambda t: t.bitwiseAND(m) < SUBSETS)))


def with_sample(df: DataFrame, kept: str, size: str, sample: str) -> DataFrame:
    """``df`` with the number of the kept terms and those of its level's hashed subsets."""
    return df.withColumn(size, F.size(kept)).withColumn(sample, _sampled(F.col(kept), _level(F.col(size))))


def broad_hashes(terms: Column) -> Column:
    """The hash of the sorted terms, a colon, and those of the broad subsets, joined by commas."""

    def every(ordered: Column) -> Column:
        of = lambda k: F.filter(ordered, lambda t: F.shiftright(t, BROAD_BITS + 2 * k).bitwiseAND(F.lit(3)) != 0)
        code = lambda k: F.lpad(F.hex(F.hash(of(k)).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")
        return F.concat(F.lpad(F.hex(F.xxhash64(ordered)), 16, "0"), F.lit(":"), F.concat_ws(",", *[code(k) for k in range(BROAD)]))

    return _let(F.array_sort(terms), every)


def matching(a: Column, b: Column) -> Column:
    """Whether two fingerprints agree on the whole lexicon or on a broad subset."""
    codes = lambda x: F.split(F.substring_index(F.substring_index(x, "|", 1), ":", -1), ",")
    same = F.exists(F.arrays_zip(codes(a).alias("a"), codes(b).alias("b")), lambda p: p["a"] == p["b"])
    return F.when((a == "") | (b == ""), (a == "") & (b == "")).otherwise((F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1)) | same)


def with_fingerprint(df: DataFrame, size: str, sample: str, broad: str, out: str) -> DataFrame:
    """``df`` with the fingerprint: broad hashes, ``|``, ``level:hashes/level+1:hashes/...``, joined by commas.

    Each small hash has the subset's number (two hex digits) and the hash of its sorted terms.
    The own level comes first; after the second, levels without hashes are left out.
    ``sample`` may have more terms than those of the level's subsets.
    """

    def subset(terms: Column, j: Column) -> Column:
        code = F.hash(F.filter(terms, lambda t: _number(t) == j)).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
        return F.concat(F.lpad(F.hex(j), 2, "0"), F.lpad(F.hex(code), 8, "0"))

    def part(at: Column) -> Column:
        numbers = F.array_sort(F.array_distinct(F.transform(at["terms"], _number)))
        return F.concat(at["level"].cast("string"), F.lit(":"), F.array_join(F.transform(numbers, lambda j: subset(at["terms"], j)), ","))

    def parts(own: Column) -> Column:
        levels = F.sequence(own["level"], F.lit(HIGHEST + 1))
        every = F.transform(levels, lambda level: F.struct(level.alias("level"), _sampled(own["low"], level).alias("terms")))
        filled = F.filter(every, lambda at: (at["level"] <= own["level"] + 1) | (F.size(at["terms"]) > 0))
        return F.array_join(F.transform(filled, part), "/")

    own = _let(_level(F.col(size)), lambda level: F.struct(level.alias("level"), _sampled(F.col(sample), level).alias("low")))
    return df.withColumn(out, F.when(F.col(size) > 0, F.concat(broad, F.lit("|"), _let(own, parts))).otherwise(""))


def with_kept_fingerprint(df: DataFrame, kept: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of its array of kept terms."""
    steps = with_sample(df, kept, "_size", "_sample").withColumn("_broad", broad_hashes(F.col(kept)))
    return with_fingerprint(steps, "_size", "_sample", "_broad", out).drop("_size", "_sample", "_broad")


def _own_fingerprint(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df``, with the columns ``_common`` and ``_singles``, with the fingerprint of a counted text."""
    steps = df.withColumn("_terms", term_hashes(F.col(text_col))).withColumn("_kept", F.array_except(F.array_except("_terms", "_common"), "_singles"))
    steps = steps.withColumn("_kept", F.when(F.size("_kept") > 0, F.col("_kept")).otherwise(F.col("_terms")))
    return with_kept_fingerprint(steps, "_kept", out).drop("_terms", "_kept")


def likeness(a: Column, b: Column) -> Column:
    """Share of the small subsets filled in either fingerprint that agree, at a common level.

    Where the whole lexicon's hashes agree it is 1; else at most one half subset less
    than 1, as the kept terms differ.  The level is the higher of both own levels; fingerprints of the same own level are also
    compared at the next, and the better counts.  A level left out has no hashes.
    """
    first = lambda x: F.substring_index(x, ":", 1).try_cast("int")
    number = lambda h: F.substring(h, 1, 2)

    def hashes(x: Column, level: Column) -> Column:
        part = F.get(F.filter(F.split(x, "/"), lambda p: first(p) == level), F.lit(0))
        return F.filter(F.split(F.coalesce(F.substring_index(part, ":", -1), F.lit("")), ","), lambda h: h != "")

    def share(at: Column) -> Column:
        same = F.size(F.array_intersect(at["mine"], at["yours"]))
        filled = F.size(F.array_union(F.transform(at["mine"], number), F.transform(at["yours"], number)))
        return F.when(filled > 0, same / filled).otherwise(F.lit(0.0))

    def best(pair: Column) -> Column:
        at = lambda level: _let(F.struct(hashes(pair["a"], level).alias("mine"), hashes(pair["b"], level).alias("yours")), share)
        return F.when(pair["x"] == pair["y"], F.greatest(at(pair["x"]), at(pair["x"] + 1))).otherwise(at(F.greatest(pair["x"], pair["y"])))

    fine = lambda x: F.substring_index(x, "|", -1)
    pair = F.struct(fine(a).alias("a"), fine(b).alias("b"), first(fine(a)).alias("x"), first(fine(b)).alias("y"))
    most = F.lit(1 - 1 / (2 * SUBSETS))
    whole = F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1)
    return F.when((a == "") | (b == ""), (a == b).cast("double")).when(whole, F.lit(1.0)).otherwise(F.least(most, _let(pair, best)))


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with their fingerprints, by the terms of the same documents (both stored first)."""
    carried = [c for c in docs.columns if c != out]
    rows = docs.select(F.struct(*carried).alias("row") if carried else F.lit(None).alias("row"), F.col(text_col).alias("text"))
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    terms = stored(in_band(term_counts(rows, ["_row"]), rows), "terms")
    common = stored(common_terms(terms), "common")
    singles = terms.where("band = -1").groupBy("_row").agg(F.collect_list("term").alias("_singles"))
    known = rows.join(singles, "_row", "left").withColumn("_singles", F.coalesce("_singles", F.array().cast("array<bigint>")))
    found = _own_fingerprint(known.withColumn("_common", common.scalar()), "text", "_fingerprint")
    return found.select(*[F.col("row")[c].alias(c) for c in carried], F.col("_fingerprint").alias(out))


def _dealt(docs: DataFrame, id_col: str, parts: int | None = None) -> DataFrame:
    """``docs`` with ``_range``: ranges of ids, nulls in the first."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    bounds = docs.agg(F.percentile_approx(id_col, shares, 10000).alias("bounds")) if shares else docs.agg(F.array().alias("bounds"))
    bounds = stored(bounds.select(F.array_distinct(F.coalesce("bounds", F.array())).cast("array<bigint>").alias("bounds")), "bounds")
    dealt = docs.withColumn("_bounds", bounds.scalar())
    return dealt.withColumn("_range", F.coalesce(F.size(F.filter("_bounds", lambda b: b <= F.col(id_col))), F.lit(0))).drop("_bounds")


def _guests(dealt: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """The first row of each range as a guest in the range before (of the first: in the last)."""
    firsts = dealt.groupBy("_range").agg(F.min(F.struct(F.col(id_col).isNotNull().alias("some"), F.col(id_col).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])).alias("first"))
    firsts = stored(firsts, "firsts")  # one row per range; the window sees the ranges' numbers only
    last = firsts.agg(F.max("_range"))
    before = firsts.select("_range", F.coalesce(F.lag("_range").over(Window.orderBy("_range")), last.scalar()).alias("_to"))
    return firsts.join(before, "_range").withColumn("_range", F.col("_to")).select("_range", F.lit(True).alias("_guest"), F.col("first.id").alias(id_col), *[F.col(f"first.c{i}").alias(c) for i, c in enumerate(columns)])


def _ahead(both: DataFrame, id_col: str, order: list[str], columns: list[str]) -> DataFrame:
    """The rows but the guests with ``next_<column>``."""
    window = Window.partitionBy("_range").orderBy("_guest", F.col(id_col).asc_nulls_first(), *order)
    return both.withColumns({f"next_{c}": F.lead(c).over(window) for c in columns}).where(~F.col("_guest")).drop("_range", "_guest")


def with_next(docs: DataFrame, id_col: str, columns: list[str], parts: int | None = None) -> DataFrame:
    """``docs`` with ``next_<column>``: the columns of the next row by id (after the last: the first).

    Rows are dealt into ranges of ids, once; the first row of each range also travels to
    the range before, so no window ever sees more than one range.
    """
    dealt = _dealt(docs, id_col, parts)
    both = dealt.withColumn("_guest", F.lit(False)).unionByName(_guests(dealt, id_col, columns), allowMissingColumns=True)
    return _ahead(both, id_col, columns, columns)


def with_edited(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) with the fingerprints of the text, the next row's and the edited text.

    The edited text has the second half replaced by the beginning of the next.  Texts are
    shuffled once, together with their terms of one document only.  The edited text's terms
    are in the band if they are in the band of either text; words made by the cuts
    (two at most) are looked up, after which the level can only rise, so that a sample
    of the other terms is enough; the broad hashes are made for either outcome.

    A document is its id and text (by hash among those of one id): a term of one row only
    belongs to an id and text that occur once, and rows that are the same are counted and
    put back after the shuffle.
    """
    dealt = _dealt(docs.withColumn("_row", F.xxhash64("text")), "doc_id", parts)
    terms = stored(in_band(term_counts(dealt, ["_range", "doc_id", "_row"]), docs), "terms")
    common = stored(common_terms(terms), "common")
    guests = _guests(dealt, "doc_id", ["text", "_row"])
    singles = terms.where("band = -1").select("_range", F.lit(False).alias("_guest"), "doc_id", "_row", "term")
    hosts = guests.select(F.col("doc_id").alias("_id"), F.col("_row").alias("_of"), F.col("_range").alias("_to"))
    theirs = singles.join(hosts, (F.col("_row") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select(F.col("_to").alias("_range"), F.lit(True).alias("_guest"), "doc_id", "_row", "term")
    rows = dealt.withColumn("_guest", F.lit(False)).unionByName(guests).withColumn("_copy", F.lit(1))
    for more in (singles, theirs):
        rows = rows.unionByName(more, allowMissingColumns=True)
    known = rows.repartition("_range").groupBy("_range", "_guest", "doc_id", "_row").agg(F.max("text").alias("text"), F.collect_list("term").alias("_singles"), F.count("_copy").alias("_copies"))
    known = known.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy")).drop("_copies", "_copy")
    own = _own_fingerprint(known.withColumn("_common", common.scalar()), "text", "fingerprint")
    ahead = _ahead(own, "doc_id", ["text", "_row"], ["text", "fingerprint", "_singles"])
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    edited = ahead.withColumn("edited", F.concat(F.left("text", (n - half).cast("int")), F.left("next_text", half)))
    edited = edited.withColumn("_terms", term_hashes(F.col("edited")))
    edited = edited.withColumn("_known", F.array_except(F.array_except(F.array_except("_terms", "_common"), "_singles"), "next__singles"))
    edited = edited.withColumn("_new", F.array_except(F.array_except("_known", term_hashes(F.col("text"))), term_hashes(F.col("next_text"))))
    edited = edited.withColumn("_kept", F.array_except("_known", "_new"))
    for name, kept in (("", "_kept"), ("_all", "_terms")):
        edited = with_sample(edited, kept, f"_size{name}", f"_sample{name}")
    # for every choice of the new words: bit k of the choice has word k
    chosen = lambda choice: F.filter(F.col("_new"), lambda t, k: F.get(F.array(*[F.floor(choice / 2**b) % 2 == 1 for b in range(2)]), k))
    choices = F.sequence(F.lit(0), F.element_at(F.array(F.lit(0), F.lit(1), F.lit(3)), F.size("_new") + 1))
    edited = edited.withColumn("_broads", F.transform(choices, lambda c: broad_hashes(F.concat("_kept", chosen(c)))))
    edited = edited.withColumn("_broad_all", broad_hashes(F.col("_terms")))
    narrow = stored(
        edited.select(
            "doc_id",
            n.cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            "fingerprint",
            "next_fingerprint",
            F.monotonically_increasing_id().alias("_at"),
            "_new",
            "_size",
            "_sample",
            "_broads",
            *[F.when(F.col("_size") == 0, F.col(c)).alias(c) for c in ("_size_all", "_sample_all", "_broad_all")],
        ),
        "edited",
    )
    new = narrow.select("_at", F.explode_outer("_new").alias("term")).where("term is not null")
    inside = new.join(terms.where("band = 0").select("term"), "term", "left_semi").groupBy("_at").agg(F.collect_list("term").alias("_inside"))
    both = narrow.join(inside, "_at", "left").withColumn("_inside", F.coalesce("_inside", F.array().cast("array<bigint>")))
    none = (F.col("_size") == 0) & (F.size("_inside") == 0)
    both = both.withColumn("_sample", F.when(none, F.col("_sample_all")).otherwise(F.concat("_sample", "_inside")))
    choice = sum(F.coalesce(F.array_contains("_inside", F.get("_new", F.lit(k))), F.lit(False)).cast("int") * 2**k for k in range(2))
    both = both.withColumn("_broad", F.when(none, F.col("_broad_all")).otherwise(F.get("_broads", choice)))
    both = both.withColumn("_size", F.when(none, F.col("_size_all")).otherwise(F.col("_size") + F.size("_inside")))
    return with_fingerprint(both, "_size", "_sample", "_broad", "edited_fingerprint").select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint")


@query
def op4_imatch_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_edited(docs).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
