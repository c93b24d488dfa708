"""Near-duplicate documents by bottom-k sketches from one hash function.

1. Every whole text becomes its set of distinct word shingles (64-bit names, which
   are the values of the one hash function).  The ``k`` least names are its sketch.
2. Equal sets are one class with one representative; copies never meet in pairs.
3. Inverted lists: a class is listed under its ``q`` least values.  Two sets of
   similarity ``t`` share none of them with probability below ``(1-t)**q``, at most
   ``MISS`` by the choice of ``q``; lists of one class end here.
4. Pairs of a list are filtered by set size, by ownership (a pair belongs to the list
   of its least shared value only) and by the estimate from the union's sketch (the
   cut-off lets a true pair fail with probability at most ``MISS``).  No pairs are
   written: a list yields the classes that still have a partner in it.
5. The texts of those classes are sent to the list and every surviving pair is checked
   exactly on full sets, unless it is already connected there; a spanning forest of
   confirmed links is written, never all pairs.
6. Components of the links by large-star and small-star steps.

Long lists are cut into blocks of ``BLOCK`` classes; each pair of blocks is one group,
so a value that a third of all documents share is spread over many tasks and no
group exceeds two blocks.

Definitions: null or empty texts have no shingles and link with nothing; texts with
fewer words than a shingle have the whole sequence as one; a null id counts as larger
than every other; rows that share id and text are the same document; columns named
like a result column are replaced; empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm import kernels as K, query
from ledgerlens.llm.passages import NO_ID
from ledgerlens.llm.tables import Forest, components, stored, whole_groups

#: Values of a sketch.
SKETCH = 64
#: Chance to lose a link of exactly the threshold, for the lists and for the estimate.
MISS = 1e-7
#: Classes of a list that are compared as one block.
BLOCK = 512
#: Pairs whose sketches are compared at a time.
PAIRS = 1 << 14

_PAD = np.uint32(0xFFFFFFFF)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle names of each text."""
    low = K.lower_ascii(buf)
    starts, ends, base = K.token_spans(low, offsets)
    names = K.token_names(low, starts, ends)
    windows = K.window_names(names, shingle)
    out = []
    for b, e in zip(base[:-1], base[1:]):
        if e - b >= shingle:
            out.append(np.unique(windows[b : e - shingle + 1]))
        elif e > b:
            out.append(K.slice_names(names[b:e], np.array([0]), np.array([e - b])))
        else:
            out.append(windows[:0])
    return out


def list_values(threshold: float) -> int:
    """How many least values a class is listed under."""
    return max(2, math.ceil(math.log(MISS) / math.log(1 - threshold)))


def cutoffs(threshold: float) -> np.ndarray:
    """By size of the union's sketch: the least overlap that a true pair falls below
    with probability ``MISS`` at most (binomial lower tail)."""
    out = np.zeros(SKETCH + 1, np.int64)
    for n in range(1, SKETCH + 1):
        tail, c = 0.0, 0
        while c < n:
            tail += math.comb(n, c) * threshold**c * (1 - threshold) ** (n - c)
            if tail > MISS:
                break
            c += 1
        out[n] = c
    return out


_SKETCHED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("tag", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("one", T.LongType()),
        T.StructField("two", T.LongType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.BinaryType()),
    ]
)


def _sketch(shingle: int, q: int):
    def run(batches):
        for batch in K.chunks(batches, "text"):
            sets = shingle_sets(*K.text_buffer(batch.column("text")), shingle)
            size = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate(sets)
            total = np.concatenate([[0], np.cumsum(size)])
            names = []
            for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(K.mix(flat ^ np.uint64(salt)))])
                names.append(K.mix(sums[total[1:]] - sums[total[:-1]] + size.astype(np.uint64)).view(np.int64))
            few = np.minimum(size, q)
            keys = flat[K.ragged(total[:-1], few)].view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(few)]).astype(np.int32)), pa.array(keys))
            sketches = [(s[:SKETCH] >> np.uint64(32)).astype(np.uint32).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tag"), pa.array(size), pa.array(names[0]), pa.array(names[1]), lists, pa.array(sketches, pa.binary())],
                names=_SKETCHED.names,
            )

    return run


class _Classes:
    """The classes of some groups, with their list values and sketches as matrices."""

    def __init__(self, sets_keys: list[np.ndarray], sketches: list[np.ndarray], size: np.ndarray, q: int):
        n = len(size)
        self.size = size
        self.keys = np.full((n, q), _NONE)
        self.sketch = np.full((n, SKETCH), _PAD)
        for row, (k, s) in enumerate(zip(sets_keys, sketches)):
            self.keys[row, : len(k)] = k
            self.sketch[row, : len(s)] = s

    def likely(self, a: np.ndarray, b: np.ndarray, value: np.ndarray, percent: int, cut: np.ndarray):
        """Which pairs belong to the list of ``value`` and may reach the threshold; their estimates."""
        small, large = np.minimum(self.size[a], self.size[b]), np.maximum(self.size[a], self.size[b])
        keep = np.flatnonzero(100 * small >= percent * large)
        ka, kb, v = self.keys[a[keep]], self.keys[b[keep]], value[keep, None]
        earlier = np.zeros(len(keep), bool)
        for j in range(kb.shape[1]):
            earlier |= ((ka == kb[:, j, None]) & (ka < v)).any(axis=1)
        keep = keep[~earlier]
        both = np.sort(np.concatenate([self.sketch[a[keep]], self.sketch[b[keep]]], axis=1), axis=1)
        real = both != _PAD
        again = np.zeros(both.shape, bool)
        again[:, 1:] = both[:, 1:] == both[:, :-1]
        rank = np.cumsum(~again, axis=1, dtype=np.int16)
        inside = real & (rank <= SKETCH)
        union = (inside & ~again).sum(axis=1)
        common = (inside & again).sum(axis=1)
        ok = common >= cut[union]
        return keep[ok], common[ok] / np.maximum(union[ok], 1)


def _pairs(group: np.ndarray, block: np.ndarray, cross: np.ndarray):
    """Blocks of row pairs of the same group (of different blocks in a cross group)."""
    edge = np.flatnonzero(K.group_starts(group))
    stop = np.repeat(np.append(edge[1:], len(group)), np.diff(np.append(edge, len(group))))
    rows = np.arange(len(group))
    held, count, d = [], 0, 1
    while True:
        rows = rows[rows + d < stop[rows]]
        if not len(rows):
            break
        a, b = rows, rows + d
        ok = ~cross[a] | (block[a] != block[b])
        held.append((a[ok], b[ok]))
        count += len(held[-1][0])
        d += 1
        if count >= PAIRS:
            yield from _even(held)
            held, count = [], 0
    if held:
        yield from _even(held)


def _even(held):
    a, b = (np.concatenate(x) for x in zip(*held))
    for i in range(0, len(a), PAIRS):
        yield a[i : i + PAIRS], b[i : i + PAIRS]


def _group_numbers(table: pa.Table):
    value, i, j, block = (table.column(c).to_numpy() for c in ("value", "i", "j", "block"))
    return value.view(np.uint64), np.cumsum(K.group_starts(value, i, j)), block, i != j


_MEMBER = T.StructType([T.StructField(c, T.LongType() if c in ("value", "id", "tag", "one") else T.IntegerType()) for c in ("value", "i", "j", "block", "id", "tag", "one")])


def _partnered(percent: int, q: int):
    """Classes that still have a partner in their list."""

    def run(batches):
        cut = cutoffs(percent / 100)
        for table in whole_groups(batches, "value", "i", "j"):
            value, group, block, cross = _group_numbers(table)
            keys = table.column("keys").combine_chunks()
            at, flat = np.asarray(keys.offsets), np.asarray(keys.values).view(np.uint64)
            sketches = [np.frombuffer(s, np.uint32) for s in table.column("sketch").to_pylist()]
            c = _Classes([flat[x:y] for x, y in zip(at[:-1], at[1:])], sketches, table.column("n").to_numpy(), q)
            hit = np.zeros(len(value), bool)
            for a, b in _pairs(group, block, cross):
                keep, _ = c.likely(a, b, value[a], percent, cut)
                hit[a[keep]] = hit[b[keep]] = True
            if hit.any():
                yield from table.select(_MEMBER.names).filter(pa.array(hit)).combine_chunks().to_batches()

    return run


_VERTEX = T.StructType([T.StructField("id", T.LongType()), T.StructField("one", T.LongType())])


def _confirmed(percent: int, shingle: int, q: int):
    """A spanning forest of the links that full sets confirm, list by list."""

    def run(batches):
        cut = cutoffs(percent / 100)
        for table in whole_groups(batches, "value", "i", "j", rows=4096, size=16 << 20):
            value, group, block, cross = _group_numbers(table)
            sets: list[np.ndarray] = []
            for piece in K.chunks(table.select(["text"]).to_batches(), "text"):
                sets += shingle_sets(*K.text_buffer(piece.column("text")), shingle)
            size = np.array([len(s) for s in sets], np.int64)
            c = _Classes([s[:q] for s in sets], [(s[:SKETCH] >> np.uint64(32)).astype(np.uint32) for s in sets], size, q)
            forest, links = Forest(), []
            found = []
            for a, b in _pairs(group, block, cross):
                keep, guess = c.likely(a, b, value[a], percent, cut)
                found.append((a[keep], b[keep], guess))
                if sum(len(f[0]) for f in found) >= 1 << 18:
                    _link(found, sets, size, percent, forest, links)
                    found = []
            if found:
                _link(found, sets, size, percent, forest, links)
            if links:
                a, b = (np.array(x) for x in zip(*links))
                ids, one = table.column("id").to_numpy(), table.column("one").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.StructArray.from_arrays([pa.array(ids[x]), pa.array(one[x])], names=["id", "one"]) for x in (a, b)], names=["a", "b"]
                )

    return run


def _link(found, sets, size, percent, forest: Forest, links: list) -> None:
    """Check pairs exactly, the likeliest first, unless a chain of links joins them already."""
    a, b, guess = (np.concatenate(x) for x in zip(*found))
    for p in np.argsort(-guess, kind="stable"):
        x, y = int(a[p]), int(b[p])
        if forest.root(x) == forest.root(y):
            continue
        both = np.concatenate([sets[x], sets[y]])
        both.sort()
        common = int((both[1:] == both[:-1]).sum())
        if 100 * common >= percent * (len(both) - common):
            forest.join(x, y)
            links.append((x, y))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``tag`` (of the text), ``n_shingles``, ``component_id``.

    Links join documents whose shingle sets have a Jaccard similarity of ``percent``
    hundredths or more; ``component_id`` is the smallest id reachable, itself included.
    Runs jobs: sketches, representatives and links are stored in the shared folder.
    """
    q = list_values(percent / 100)
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"),
        F.col(text_col).alias("text"),
    )
    sketched = stored(keyed.mapInArrow(K.tidy(_sketch(shingle, q)), _SKETCHED), "sketches")
    classes = stored(
        sketched.where("n > 0")
        .groupBy("one", "two")
        .agg(F.min(F.struct("id", "tag")).alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
        .select("one", "two", "rep.id", "rep.tag", "n", "keys", "sketch"),
        "classes",
    )
    listed = classes.select("one", "two", F.explode("keys").alias("value"))
    lists = listed.groupBy("value").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = (
        listed.join(lists, "value")
        .join(classes, ["one", "two"])
        .withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("one"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("value", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "id", "tag", "one", "n", "keys", "sketch")
    )
    group = ["value", "i", "j"]
    partnered = stored(members.repartition(n, *group).sortWithinPartitions(*group).mapInArrow(K.tidy(_partnered(percent, q)), _MEMBER), "partnered")
    # merge: the texts are shuffled whatever their number, so that the plan is the same at every size
    texts = partnered.hint("merge").join(keyed, ["id", "tag"]).select(*_MEMBER.names, "text")
    edges = T.StructType([T.StructField("a", _VERTEX), T.StructField("b", _VERTEX)])
    links = texts.repartition(n, *group).sortWithinPartitions(*group).mapInArrow(K.tidy(_confirmed(percent, shingle, q)), edges)
    roots = components(links, "links").select("a.id", "a.one", F.col("root.id").alias("root"))
    of_class = classes.select("one", "two", "id").join(roots, ["id", "one"], "left").select("one", "two", F.coalesce("root", "id").alias("component"))
    return (
        sketched.select("id", "tag", "n", "one", "two")
        .join(of_class, ["one", "two"], "left")
        .select("id", "tag", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one with its smallest id.

    Rows that share id and text are the same document; one of them stays.
    """
    kept = near_duplicates(docs, id_col, text_col, **options).where("id = component_id").select("id", "tag").distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"))
    return keyed.join(kept, ["id", "tag"], "left_semi").dropDuplicates(["id", "tag"]).select("row.*")


@query
def op9_bottomk_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's set size, component and whether it stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs, shingle=3, percent=85)
    own = F.when(F.col("id") != NO_ID, F.col("id"))
    return found.select(
        own.alias("doc_id"), "n_shingles", F.when(F.col("component_id") != NO_ID, F.col("component_id")).alias("component_id"), (F.col("id") == F.col("component_id")).alias("kept")
    )
