"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

* *Targets.*  Sources in code-point order (null last) weigh 3, 1, 2, repeating, and
  share 150 % of all words; no target exceeds twice its source's words, the excess is
  reshared by weight until none is above.
* *Blocks.*  Each source's documents fall by hash into blocks.  A source gives whole
  passes over its blocks, then whole blocks in a permuted order up to its target, and of
  the blocks after them the documents that still fit, until nothing does (``_filled``).  That
  fixes an exact quota of block draws for each source.
* *Splitting tree.*  The quotas of all sources are divided between the two halves of
  the output shards by a multivariate-hypergeometric draw, and so on down to single
  shards: every shard gets an exact composition, close to the overall one.
* *Draws.*  A source's block draws are permuted; the shards take disjoint stretches of
  that order.  ``shard_order`` shuffles the documents inside a shard, and ``mix`` deals its
  rows by shard and ranges of that order.

Only one row per (source, block) and one number per (source, shard) is handled beside the
documents; the documents themselves are joined with those, never gathered (a block that
is filled one by one has its documents' sizes in one task, at most a ``MOST_BLOCKS``-th).  All choices
are hashes of ids and the seed, so reruns agree.

Definitions: the size is the number of words of the whole text (null: 0); a document
is never split; rows that share id and text are taken together, each as often as the
other; null sources are one source; a null id is an id of its own; columns named like
a result column are replaced; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.llm import query
from ledgerlens.llm.passages import NO_ID
from ledgerlens.llm.tables import stored

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix has; most passes over one source.
TOTAL, MOST = 1.5, 2.0
#: Documents of a block (about), and most blocks of a source.
BLOCK_DOCS, MOST_BLOCKS = 64, 1 << 16
SHARDS = 16
SEED = 17


def word_count(text):
    """Words of a text: runs of anything but space and the controls 9-13 (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, tag (of the text), source and size of every document."""
    return docs.select(
        *_key(id_col, text_col), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )


def _key(id_col: str, text_col: str) -> list:
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    return [ids.alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag")]


def targets(sized: DataFrame) -> DataFrame:
    """source, documents, source_size, weight, target; one row per source.

    The sources are ranked over their own small table; the reshare needs only sums.
    """
    sources = sized.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("size").alias("source_size"))
    # ranks: sort the sources into ranges, number each range, add the counts before it
    ranged = stored(
        sources.withColumns({"none": F.col("source").isNull(), "key": F.coalesce("source", F.lit(""))})
        .repartitionByRange("none", "key")
        .withColumn("range", F.spark_partition_id()),
        "sources",
    )
    inside = F.row_number().over(Window.partitionBy("range").orderBy("none", "key"))
    counts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    place = F.col("before") + inside - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place % len(WEIGHTS)).cast("int") + 1)
    ranked = stored(ranged.join(before, "range").select("source", "documents", "source_size", weight.cast("double").alias("weight"), place.alias("place")), "weights")
    sums = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    left, weights, level = TOTAL * (sums["words"] or 0), sums["weight"] or 0.0, 0.0
    cap = F.col("source_size") * MOST
    while weights > 0:  # each round fixes at least one more source at its cap, or ends
        level = left / weights
        full = ranked.where(cap <= F.lit(level) * F.col("weight")).agg(F.sum(cap).alias("words"), F.sum("weight").alias("weight")).first()
        now = TOTAL * sums["words"] - (full["words"] or 0.0)
        rest = sums["weight"] - (full["weight"] or 0.0)
        if rest == weights:
            break
        left, weights = now, rest
    return ranked.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")) if weights > 0 else cap)


def _fill(words: np.ndarray, order: np.ndarray, room: float) -> np.ndarray:
    """Documents that fit into ``room`` one after another, in hash order."""
    taken, left = np.zeros(len(words), bool), room
    for i in order:
        if words[i] <= left:
            taken[i] = True
            left -= words[i]
    return taken


def _fill_block(group: pd.DataFrame) -> pd.DataFrame:
    taken = _fill(group["words"].to_numpy(), np.argsort(group["turn"].to_numpy(), kind="stable"), float(group["room"].iloc[0]))
    return group.loc[taken, ["place", "block", "id", "tag", "words"]]


_PICKED = "place long, block int, id long, tag long, words long"


def _block_order(seed: int):
    return Window.partitionBy("place").orderBy(F.xxhash64("place", "block", F.lit(seed)), "block")


def _filled(rest: DataFrame, room: DataFrame, seed: int) -> DataFrame:
    """Documents (place, block, id, tag, words) of ``rest`` that fill the rooms of the sources.

    ``rest``: documents not taken yet in the last pass; ``room``: words left per source.  In
    each round the documents that fit are summed by block; blocks go in their permuted
    order as long as all their fitting documents have room, and the block after them is
    filled one document after another.  What is left then is less than a document of
    that block, so the next round has smaller rooms; the end is where nothing fits.  At last the
    smallest document is taken where the excess is less than what is missing.
    """
    picks = None
    while True:
        left = room if picks is None else room.join(picks.groupBy("place").agg(F.sum("words").alias("got")), "place", "left").select("place", (F.col("room") - F.coalesce("got", F.lit(0))).alias("room"))
        free = rest if picks is None else rest.join(picks, ["place", "block", "id", "tag"], "left_anti")
        fit = free.join(left, "place").where((F.col("words") > 0) & (F.col("words") <= F.col("room")))
        blocks = fit.groupBy("place", "block", "room").agg(F.sum("words").alias("in_block"))
        blocks = stored(blocks.withColumn("upto", F.sum("in_block").over(_block_order(seed))).withColumn("start", F.col("upto") - F.col("in_block")), "room")
        if blocks.isEmpty():
            break
        used = blocks.where("start < room").select("place", "block", (F.col("room") - F.col("start")).alias("room"), (F.col("upto") <= F.col("room")).alias("whole"))
        chosen = fit.drop("room").join(used, ["place", "block"])
        some = chosen.where("not whole").withColumn("turn", F.xxhash64("id", "tag", F.lit(seed + 2))).drop("whole")
        more = chosen.where("whole").select("place", "block", "id", "tag", "words").unionByName(some.groupBy("place", "block").applyInPandas(_fill_block, _PICKED))
        picks = stored(more if picks is None else picks.unionByName(more), "picks")
    least = free.where("words > 0").groupBy("place").agg(F.min(F.struct("words", "id", "tag", "block")).alias("d"))
    help_ = least.join(left, "place").where("d.words - room < room").select("place", "d.block", "d.id", "d.tag", "d.words")
    return stored(help_ if picks is None else picks.unionByName(help_), "picks")


def _tree(seed: int, shards: int):
    def run(sources: pd.DataFrame) -> pd.DataFrame:
        """Quotas of (source, shard): the splitting tree over all sources."""
        sources = sources.sort_values("place")
        place, rng = sources["place"].to_numpy(), np.random.default_rng(seed)
        out = []

        def split(first: int, many: int, quota: np.ndarray) -> None:
            if many == 1:
                out.append(pd.DataFrame({"place": place, "shard": first, "quota": quota}))
                return
            half, total = many // 2, int(quota.sum())
            left = rng.multivariate_hypergeometric(quota, total * half // many, method="marginals")
            split(first, half, left)
            split(first + half, many - half, quota - left)

        split(0, shards, sources["draws"].to_numpy())
        result = pd.concat(out)
        result = result.sort_values(["place", "shard"])
        result["first"] = result.groupby("place")["quota"].cumsum() - result["quota"]
        return result[result["quota"] > 0][["place", "shard", "first", "quota"]]

    return run


def plan(sized: DataFrame, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sources with their targets, the block draws, and the documents that fill the rest.

    ``sized``: id, tag, source, size (see ``keyed``), stored.  Draws: place, block, copies
    (pass, shard, whether only picked documents are meant).  Picks: place, block, id, tag.
    """
    blocks = F.least(F.lit(MOST_BLOCKS), F.ceil(F.col("documents") / BLOCK_DOCS)).cast("int")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + F.lit(1e-9))).otherwise(0).cast("int")
    sources = stored(targets(sized).withColumns({"blocks": blocks, "passes": whole}), "targets")
    placed = _placed(sized, sources, seed)
    sizes = stored(
        placed.groupBy("place", "block", "blocks", "passes", "target", "source_size").agg(F.sum("size").alias("words")),
        "blocks",
    )
    room = F.col("target") - F.col("passes") * F.col("source_size")
    state = stored(sizes.withColumns({"room": room, "upto": F.sum("words").over(_block_order(seed))}), "state")
    again = state.where((F.col("upto") <= F.col("room")) & (F.col("room") > 0))
    missing = again.groupBy("place").agg(F.max("upto").alias("got"))
    missing = state.select("place", "room").distinct().join(missing, "place", "left").select("place", (F.col("room") - F.coalesce("got", F.lit(0))).alias("room")).where("room > 0")
    rest = placed.join(again.select("place", "block"), ["place", "block"], "left_anti").groupBy("place", "block", "id", "tag").agg(F.sum("size").alias("words"))
    picks = _filled(rest, stored(missing, "missing"), seed)
    passes = sizes.select("place", "passes").distinct()
    draws = stored(
        again.select("place", "block", F.col("passes").alias("pass"), F.lit(False).alias("last"))
        .unionByName(picks.select("place", "block").distinct().join(passes, "place").select("place", "block", F.col("passes").alias("pass"), F.lit(True).alias("last")))
        .unionByName(sizes.where("passes > 0").select("place", "block", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("pass"), F.lit(False).alias("last"))),
        "draws",
    )
    rank = F.row_number().over(Window.partitionBy("place").orderBy(F.xxhash64("place", "block", "pass", F.lit(seed + 1)), "block", "pass")) - 1
    ranked = draws.withColumn("rank", rank)
    # one row per source: the whole tree in one task is one number per source and shard
    quotas = draws.groupBy("place").agg(F.count(F.lit(1)).alias("draws"))
    tree = quotas.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(_tree(seed, shards), "place long, shard int, first long, quota long")
    ranges = tree.select("place", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("quota") - 1)).alias("rank"))
    copies = (
        ranked.join(ranges, ["place", "rank"])
        .groupBy("place", "block")
        .agg(F.array_sort(F.collect_list(F.struct("pass", "shard", "last"))).alias("copies"))
    )
    return sources, stored(copies, "copies"), picks.select("place", "block", "id", "tag")


def _placed(sized: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Documents with their source's numbers and their block."""
    s = sources.select(F.col("source").alias("s"), "place", "blocks", "passes", "target", "source_size")
    joined = sized.join(s, sized["source"].eqNullSafe(s["s"])).drop("s")
    return joined.withColumn("block", F.pmod(F.xxhash64("id", "tag", F.lit(seed)), F.col("blocks")).cast("int"))


def with_copies(sized: DataFrame, planned: tuple[DataFrame, DataFrame, DataFrame], seed: int = SEED) -> DataFrame:
    """``sized`` (and its other columns) with source_size, target and copies.

    ``copies``: pass, shard and shard_order of each time the document is taken.
    """
    sources, copies, picks = planned
    placed = _placed(sized, sources, seed).join(copies, ["place", "block"], "left")
    found = placed.join(picks.withColumn("picked", F.lit(True)), ["place", "block", "id", "tag"], "left")
    mine = F.filter(F.coalesce("copies", F.array()), lambda c: ~c["last"] | F.coalesce(F.col("picked"), F.lit(False)))
    shown = F.transform(mine, lambda c: F.struct(c["pass"].alias("pass"), c["shard"].alias("shard"), F.xxhash64(F.col("id"), F.col("tag"), c["pass"], F.lit(seed + 3)).alias("shard_order")))
    return found.withColumn("copies", shown).drop("place", "block", "blocks", "passes", "picked")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix itself: a row of ``docs`` for each time it is taken, with ``pass``, ``shard``
    and ``shard_order``, the rows of a shard in partitions that follow one another, in its
    shuffled order: its order is a hash, so equal ranges of it hold about equally many."""
    sized = stored(keyed(docs, id_col, text_col, source_col), "sized")
    planned = plan(sized, shards, seed)
    each = with_copies(sized, planned, seed).where(F.size("copies") > 0)
    # narrow rows all the way; only here the texts are shuffled, once
    each = each.groupBy("id", "tag").agg(F.first("copies").alias("copies"))
    others = [c for c in docs.columns if c not in ("pass", "shard", "shard_order")]
    rows = docs.select(*_key(id_col, text_col), F.struct(*others).alias("row"))
    taken = rows.join(each, ["id", "tag"]).select("row", F.explode("copies").alias("copy")).select("row.*", "copy.*")
    ranges = -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)
    at = F.shiftright(F.col("shard_order"), 32) + (1 << 31)  # the upper half of the order, from 0
    part = (F.col("shard") * ranges + F.shiftright(at * ranges, 32)).cast("int")
    return taken.repartitionById(shards * ranges, part).sortWithinPartitions("shard", "shard_order")


@query
def op3_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document's size, its source's size and target, the words taken and the copies
    (pass, shard and place in the shard's order) in which they are taken."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    sized = stored(keyed(docs), "sized")
    found = with_copies(sized, plan(sized))
    return found.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.size("copies")).alias("taken"), "copies")
