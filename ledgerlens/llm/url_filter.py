"""URL filter: rules first, then a character language-model ratio.

*Rules* allow or block a host with all its subdomains below a path; the longest that
fits decides.

*Models.*  For URLs without a rule, two smoothed variable-order Markov models over the
characters of host and path (A-Z lower-cased, all others as they are), one of accepted and one
of rejected URLs, give the difference of their log-likelihoods per character.  The
probability of a character after ``ORDER`` others is the count of the whole, smoothed towards
the probability after one less, and so on down to the character's own (``SMOOTH`` pseudo-counts
each), so the longest context that was seen decides.  Training URLs are those that the rules
judge.  The cut-off is calibrated on them: where a rejected and an accepted URL are equally
many standard deviations from the mean of their class.

Counts are rows, one per context and character, and grow with the URLs.  Each order is
joined to the next shorter one, where a row meets as many others as there are characters.
The distinct texts are joined to the weights by context and summed per text; Spark splits
the partitions of frequent contexts.  Sums are decimal, so that they do not depend on the
order of rows.  All work is DataFrame expressions.

Definitions: null urls and urls without ``://`` have an empty host and path, no rule, and
a score of 0; without training URLs of both kinds the cut-off is 0 and every score 0, which
allows; repeated rows are judged each; columns named like a result column are replaced;
empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.llm import query
from ledgerlens.llm.tables import stored

#: Characters of context that decide at most.
ORDER = 5
#: Pseudo-counts that each order gives to the next shorter one.
SMOOTH = 2.0

# The rules, (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def split_url(df: DataFrame, url_col: str) -> DataFrame:
    """``df`` with ``host`` (A-Z lower-cased) and ``path``."""
    after = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    rest = F.regexp_replace(after, r"^[^/?#]*", "")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return df.withColumns({"host": F.translate(host, upper, upper.lower()), "path": F.regexp_extract(rest, r"^[^?#]*", 0)})


def rule_of(rules, host, path):
    """The longest rule (host and path in one string) that fits, else null; and its verdict."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: -len(r[1])):
        name, below, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(below + rest))
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def folded(text: Column) -> Column:
    """The text with A-Z lower-cased."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(chars: Column) -> Column:
    """All characters with the ``ORDER`` before them (NUL before the first), as strings."""
    padded = F.concat(F.array(*[F.lit("\0")] * ORDER), chars)
    return F.transform(chars, lambda c, i: F.concat(*[F.get(padded, i + k) for k in range(ORDER)], c))


def _model(judged: DataFrame) -> DataFrame:
    """A row per gram of ``judged`` (verdict or null, chars): ``gram`` and ``weight``, the log
    ratio of both models' probabilities, to nine places."""
    kinds = ("allow", "block")
    every = judged.select("verdict", F.explode_outer(grams(F.col("chars"))).alias("gram")).where("gram is not null")
    counts = stored(every.groupBy("gram").agg(*[F.count(F.when(F.col("verdict") == k, 1)).alias(k) for k in kinds]), "url-grams")
    before = None
    for order in range(ORDER + 1):
        short = counts.groupBy(F.substring("gram", ORDER + 1 - order, order + 1).alias("gram")).agg(*[F.sum(k).alias(k) for k in kinds])
        if before is None:
            symbols = short.where("allow + block > 0").agg(F.count(F.lit(1)).alias("n")).scalar() + 1  # one for all others
            totals = {k: short.agg(F.coalesce(F.sum(k), F.lit(0)).alias("n")).scalar() for k in kinds}
            found = short.select("gram", *[((F.col(k) + SMOOTH / symbols) / (totals[k] + SMOOTH)).alias(f"p_{k}") for k in kinds])
        else:
            # the window's groups and the join's have as many rows as there are characters
            context = Window.partitionBy(F.substring("gram", 1, order))
            own = short.withColumns({f"n_{k}": F.sum(k).over(context) for k in kinds}).withColumn("less", F.substring("gram", 2, order))
            both = own.join(before.withColumnRenamed("gram", "less"), "less")
            found = both.select("gram", *[((F.col(k) + SMOOTH * F.col(f"p_{k}")) / (F.col(f"n_{k}") + SMOOTH)).alias(f"p_{k}") for k in kinds])
        before = found
    return before.select("gram", (F.log("p_allow") - F.log("p_block")).cast("decimal(18,9)").alias("weight"))


def judge(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict, score (log-likelihood difference per
    character) and cutoff.  Runs jobs for the models, which are stored."""
    results = ("host", "path", "rule", "verdict", "score", "cutoff")
    carried = [c for c in pages.columns if c not in results]
    # the caller's columns travel as one, so that none meets a name used here
    base = split_url(pages.select(F.struct(*carried).alias("row") if carried else F.lit(None).alias("row"), F.col(url_col).alias("url")), "url")
    rule, verdict = rule_of(rules, F.col("host"), F.col("path"))
    text = folded(F.concat("host", "path"))
    urls = base.withColumns({"rule": rule, "_by_rule": verdict, "_key": F.md5(text.cast("binary"))})
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    model = stored(_model(base.select(verdict.alias("verdict"), chars.alias("chars"))), "url-model")
    # distinct texts are dealt into a set number of parts: they are few bytes, their grams 31 times as many
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = base.select(text.alias("text")).distinct().select("text", F.md5(F.col("text").cast("binary")).alias("_key"))
    # by the key: dealt by the text itself, Spark would take the distinct step's few large partitions
    texts = texts.repartition(parts, "_key").select("_key", F.filter(F.split("text", ""), lambda c: c != "").alias("chars"))
    grams_of = texts.select("_key", F.size("chars").alias("n"), F.explode_outer(grams(F.col("chars"))).alias("gram")).where("gram is not null")
    sums = grams_of.join(model, "gram").groupBy("_key").agg((F.sum("weight").cast("double") / F.first("n")).alias("_score"))
    scores = stored(sums, "url-scores")
    scored = urls.join(scores, "_key", "left")
    known = scored.where("_by_rule is not null and _score is not null").select(F.col("_by_rule").alias("verdict"), F.col("_score").alias("score"))
    of = lambda kind: F.when(F.col("verdict") == kind, F.col("score"))
    stats = known.agg(*[f(of(kind)).alias(f"{kind}_{name}") for kind in ("allow", "block") for name, f in (("m", F.avg), ("s", F.stddev_pop))])
    spread = F.col("allow_s") + F.col("block_s")
    middle = F.when(spread > 0, (F.col("allow_m") * F.col("block_s") + F.col("block_m") * F.col("allow_s")) / spread).otherwise((F.col("allow_m") + F.col("block_m")) / 2)
    cutoff = stored(stats.select(F.coalesce(middle, F.lit(0.0)).alias("cutoff")), "url-cutoff")
    scored = scored.withColumn("score", F.coalesce("_score", F.lit(0.0))).withColumn("cutoff", cutoff.scalar())
    by_model = F.when(F.col("score") >= F.col("cutoff"), F.lit("allow")).otherwise(F.lit("block"))
    return scored.withColumn("verdict", F.coalesce("_by_rule", by_model)).select(*[F.col("row")[c].alias(c) for c in carried], *results)


@query
def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")
