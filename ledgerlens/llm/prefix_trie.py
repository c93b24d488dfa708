"""Conversation prefix trie by fixed-length block hashing.

A turn is named by a digest of its role and text, a beginning of a conversation by the
exclusive or of its turns' digests, each hashed with its place (128 bits).  Conversations
are grouped by successive blocks of ``BLOCK_TURNS`` turns first: a group holds those that
agree up to a block's start, and one aggregation tells whether all of them go on with
the same whole block.  Where they do, the block's nodes have the group's members, and
the turns of one conversation (the smallest) give them.  Only inside blocks where
siblings diverge, or where a conversation ends, turn boundaries are refined: the beginnings
of every member's turns are grouped one by one.

A node belongs to its smallest member; so every conversation owns one path of nodes that
ends with its last turn, or none, and hangs on a node of a smaller conversation.  Sums over
subtrees are sums over the owned path from below, with the totals of all paths that hang
on it, however far down: a conversation meets the owners of its beginnings where nodes
change owner, which happens in refined blocks only.  So no step goes through the depths one
after another, and no row is made per pair of node and descendant.

Turns are rows throughout; the only lists are of at most ``PACK`` conversation ids.  Groups
(all conversations share the root, many may share a first turn) are aggregated with
partial sums, and joins have one row per key on one side, so that Spark can split a
hot key on the other.  The hash of the members that end at a node runs over texts of at
most ``PACK`` ids in order, with one running state.

Definitions: rows without conversation id are left out, as nothing could name them; null
role or text is empty; turns are ordered by turn (null first), role and text, so repeated
rows are turns of their own and ties have one order; the rows of one conversation are
ordered by one task, which keeps running digests only (Spark spills the sort); very
long texts are replaced by their digests before any group is formed; only the columns
named are read, so others may clash; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerlens.llm import query
from ledgerlens.llm.tables import stored

#: Turns of a block.
BLOCK_TURNS = 4
#: Conversation ids of which one text is made.
PACK = 4096
#: What a word is: the runs of characters outside these.
WORD = r"[^\x20\x09-\x0D]+"
#: Rebuilding for the query: a conversation takes its first turns from the one at the start of its twenty.
TWENTY, MOST_TAKEN = 20, 3

_PLACE = ["depth", "p1", "p2"]


def numbered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, digest, words): the turns of every conversation from 1, named by role and text."""
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    named = turns.withColumns({
        "digest": F.substring(F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)), 1, 16),
        "words": F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).cast("long"),
    })
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return named.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "digest", "words")


def beginnings(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, depth, digest, words) with the names of the beginnings they end (p1, p2), of
    those before them (e1, e2), and of the one before their block (s1, s2)."""
    depth = F.col("depth")
    hashed = turns.select("conv_id", depth, "words", F.floor((depth - 1) / BLOCK_TURNS).alias("block"),
                          *[F.xxhash64(F.lit(i), depth, "digest").alias(f"x{i}") for i in (1, 2)])
    up = W.partitionBy("conv_id").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    with_p = hashed.select("*", *[F.bit_xor(f"x{i}").over(up).alias(f"p{i}") for i in (1, 2)])
    with_e = with_p.select("conv_id", "depth", "words", "block", "p1", "p2", *[F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"e{i}") for i in (1, 2)])
    block = W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    return with_e.select("*", *[F.first(f"e{i}").over(block).alias(f"s{i}") for i in (1, 2)])


def last_beginnings(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2): the whole of every conversation; of those without turns the root."""
    last = rows.groupBy("conv_id").agg(F.max(F.struct(*_PLACE)).alias("last"))
    whole = members.select("conv_id").join(last, "conv_id", "left")
    return whole.select("conv_id", *[F.coalesce(F.col(f"last.{c}"), F.lit(0).cast("long")).alias(c) for c in _PLACE])


def block_groups(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Groups of conversations that agree up to a block's start: (block, s1, s2, n_convs, conv_id, diverge)."""
    went = rows.groupBy("conv_id", "block").agg(
        F.first("s1").alias("s1"), F.first("s2").alias("s2"),
        F.max(F.when(F.col("depth") % BLOCK_TURNS == 0, F.struct("p1", "p2"))).alias("next"),
    )
    ended = ends.where(F.col("depth") % BLOCK_TURNS == 0).select(
        "conv_id", F.floor(F.col("depth") / BLOCK_TURNS).alias("block"), F.col("p1").alias("s1"), F.col("p2").alias("s2"), F.lit(None).cast(went.schema["next"].dataType).alias("next")
    )
    return (
        went.unionByName(ended)
        .groupBy("block", "s1", "s2")
        .agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.count("next").alias("went"), F.min("next").alias("least"), F.max("next").alias("most"))
        .select("block", "s1", "s2", "n_convs", "conv_id", ((F.col("went") < F.col("n_convs")) | (F.col("least") != F.col("most"))).alias("diverge"))
    )


def _hash_members(batches):
    """Rows sorted by place and pack: the hash of each place's packs, one after another."""
    key = state = None
    for batch in batches:
        out = []
        for *place, text in zip(*(batch.column(c).to_pylist() for c in (*_PLACE, "text"))):
            if place != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = place, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _HASHED)], names=[*_PLACE, "sha"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*key, state.hexdigest()), _HASHED)], names=[*_PLACE, "sha"])


_HASHED = [pa.int64(), pa.int64(), pa.int64(), pa.string()]


def end_hashes(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, sha): the hash of the ids, ascending and joined by commas, that end at a place."""
    packs = ends.groupBy(*_PLACE, F.expr(f"conv_id div {PACK}").alias("pack")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("text")
    )
    return packs.repartition(*_PLACE).sortWithinPartitions(*_PLACE, "pack").mapInArrow(_hash_members, "depth long, p1 long, p2 long, sha string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of all ``members`` (conv_id), given their ``turns`` (conv_id, depth from 1, digest, words).

    One row per distinct beginning, the root included: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.  Runs jobs:
    the beginnings and the nodes are stored.
    """
    rows = stored(beginnings(turns), "beginnings")
    ends = stored(last_beginnings(rows, members), "ends")
    groups = stored(block_groups(rows, ends), "blocks")

    root = groups.where("block = 0").select(
        *[F.lit(0).cast("long").alias(c) for c in _PLACE], "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.lit(0).cast("long").alias("words"))
    shared = rows.join(groups.where("not diverge").select("conv_id", "block", "n_convs"), ["conv_id", "block"]).select(
        *_PLACE, "conv_id", F.col("conv_id").alias("parent_conv_id"), "n_convs", "words")
    apart = rows.join(groups.where("diverge").select("block", "s1", "s2"), ["block", "s1", "s2"], "left_semi")
    refined = apart.groupBy(*_PLACE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("words").alias("words"), F.first("e1").alias("e1"), F.first("e2").alias("e2"))
    refined = stored(refined, "refined")
    tops = root.unionByName(shared).select(*_PLACE, "conv_id").unionByName(refined.select(*_PLACE, "conv_id"))
    above = tops.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("e1"), F.col("p2").alias("e2"), F.col("conv_id").alias("parent_conv_id"))
    refined = refined.join(above, ["depth", "e1", "e2"]).select(*_PLACE, "conv_id", "parent_conv_id", "n_convs", "words")
    nodes = stored(root.unionByName(shared).unionByName(refined), "nodes")

    children = nodes.where("parent_conv_id is not null").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    own = nodes.join(children, ["conv_id", "depth"], "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
        "leaf": F.col("n_children").isNull().cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("words"),
    })
    own = stored(own, "paths")
    paths = own.groupBy("conv_id").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    # where a path's beginnings change owner: the paths that hang below the smaller owner's node
    heads = own.where("conv_id <> parent_conv_id").select(*_PLACE, F.col("parent_conv_id").alias("above"))
    owners = apart.select("conv_id", *_PLACE).join(paths, "conv_id")
    below = owners.join(heads, _PLACE).groupBy(F.col("above").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.sum("leaf").alias("below_leaf"), F.sum("saved").alias("below_saved"))
    down = W.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(W.unboundedPreceding, 0)
    summed = own.join(below, ["conv_id", "depth"], "left").select(
        "conv_id", *_PLACE, "parent_conv_id", "n_convs", "n_children",
        *[F.sum(F.col(c) + F.coalesce(F.col(f"below_{c}"), F.lit(0).cast("long"))).over(down).alias(c) for c in ("leaf", "saved")],
    )
    empty = hashlib.sha256().hexdigest()
    return summed.join(end_hashes(ends), _PLACE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(empty)).alias("ends_sha256"),
    )


def trie(conversations: DataFrame) -> DataFrame:
    """``prefix_trie`` of a table of turns (conv_id, turn, role, text) as it is."""
    turns = stored(numbered_turns(conversations), "turns")
    return prefix_trie(turns.withColumnRenamed("pos", "depth"), turns.select("conv_id").distinct())


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are taken from another: (turns, members).

    Conversation c has the first h = crc32(c) % 4 turns of conversation c - c % 20 (fewer
    or none if it has not so many), then its own turns after its first h.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % TWENTY
    plan = sizes.select("conv_id", base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_TAKEN + 1)).alias("h"))
    plan = plan.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    plan = plan.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))))
    first = turns.where(F.col("pos") <= MOST_TAKEN).select(F.col("conv_id").alias("base"), F.col("pos").alias("depth"), "digest", "words")
    heads = plan.join(first, "base").where("depth <= taken").select("conv_id", "depth", "digest", "words")
    own = turns.join(plan.select("conv_id", "h", "taken"), "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "digest", "words")
    return heads.unionByName(own), plan.select("conv_id")


@query
def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    turns = stored(numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "turns")
    return prefix_trie(*rebuilt(turns))
