"""Benchmark decontamination with suffix arrays of the training texts.

Every task builds the suffix arrays of its shards (a few MB of documents each): the
positions of all words, sorted by the words that follow.  Ranks by 3 words come
from one sort, ranks by 6 and then by ``window`` words from sorts of rank pairs, which
is as deep as a match has to be.  Every test suffix is then looked up by binary
search, level by level, in every shard; ranges of hits are checked word for word and
adjoining hits are joined into the longest verbatim matches with their locations.

Only the benchmark travels: in blocks of at most ``block_bytes`` of text (or one item),
one after another, each a plain map over the documents without any shuffle.  With
more than one block the columns found so far are written to the shared folder between
passes, so the driver and the executors hold one block at a time.

Definitions: texts are lower-cased in A-Z, words are runs of bytes outside the ASCII
punctuation, blanks and controls; null text has no words; an item of fewer words than
``window``, but not none, is one window as a whole; items with a null id mark words but
are not listed; rows sharing an item id are one item; repeated documents are each
judged; columns named like a result column are replaced; empty tables give empty
results, and without a benchmark nothing is hit.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm import kernels as K, query
from ledgerlens.llm.passages import per_doc, span_lists, SPANS
from ledgerlens.llm.tables import stored

#: Bytes that are not part of a word (after lower-casing).
OTHER = K.byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: Text bytes of one suffix array.
SHARD_BYTES = 4 << 20
#: Text bytes of the benchmark sent to tasks at a time.
BLOCK_BYTES = 16 << 20
#: Pairs of a test suffix and a training position checked at a time.
PAIRS = 1 << 20

MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("item_start", T.LongType()),
            T.StructField("n_words", T.LongType()),
        ]
    )
)


def _word_names(buf: np.ndarray, offsets: np.ndarray):
    buf = K.lower_ascii(buf)
    starts, ends, base = K.token_spans(buf, offsets, OTHER)
    names = K.token_names(buf, starts, ends)
    return np.where(names == 0, np.uint64(1), names), base


class Tests:
    """The suffixes of one block of benchmark items."""

    def __init__(self, texts: list[str], window: int):
        self.names, self.base = _word_names(*K.text_buffer(pa.array(texts, pa.string())))
        size = np.diff(self.base)
        self.item = np.repeat(np.arange(len(texts)), size)
        self.end = np.repeat(self.base[1:], size)
        at = np.arange(len(self.names))
        self.whole = at + window <= self.end  # a full window starts here
        self.short = at[(at == self.base[:-1][self.item]) & ~self.whole]  # items that are one window


class SuffixArray:
    """Word positions of one shard, sorted by their next 3, 6 and ``window`` words."""

    def __init__(self, names: np.ndarray, base: np.ndarray, window: int):
        self.names, self.window = names, window
        self.end = np.repeat(base[1:], np.diff(base))
        self.levels = []  # (offset of the second half, sorted keys, order, rank of each sorted key)
        key, offset, depth = _three(names, self.end), 0, 3
        while True:
            order = np.argsort(key)
            keys = key[order]
            rank = np.empty(len(order), np.uint64)
            rank[order] = np.cumsum(K.group_starts(keys)).astype(np.uint64)
            self.levels.append((offset, keys, order))
            if depth >= window:
                break
            offset = min(depth, window - depth)
            key = _pairs(rank, self.end, offset)
            depth += offset

    def find(self, names: np.ndarray, end: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ranges of every test suffix at each level (empty where there is none)."""
        out, rank = [], None
        for offset, keys, _ in self.levels:
            key = _three(names, end) if rank is None else _pairs(rank, end, offset)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            out.append((low, high))
            number = np.concatenate([[0], np.cumsum(K.group_starts(keys))]).astype(np.uint64)
            # a suffix that is absent gets a rank that no position has
            rank = np.where(high > low, number[np.minimum(high, len(keys))], np.uint64(0xFFFFFFFF))
        return out


def _later(values: np.ndarray, end: np.ndarray, offset: int) -> np.ndarray:
    """``values`` that many words on, 0 after the end of the text."""
    out = np.zeros_like(values)
    if offset < len(values):
        out[: len(values) - offset] = values[offset:]
    out[np.arange(len(values)) + offset >= end] = 0
    return out


def _three(names: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The leading bits of the names of three words as one key."""
    key = (names >> np.uint64(42)) << np.uint64(42)
    key |= (_later(names, end, 1) >> np.uint64(43)) << np.uint64(21)
    return key | (_later(names, end, 2) >> np.uint64(43))


def _pairs(rank: np.ndarray, end: np.ndarray, offset: int) -> np.ndarray:
    return (rank << np.uint64(32)) | _later(rank, end, offset)


def _matches(shard: SuffixArray, tests: Tests):
    """Blocks of (test position, training position, words) of verbatim windows."""
    if not len(shard.names) or not len(tests.names):
        return
    ranges = shard.find(tests.names, tests.end)
    window = shard.window
    full = np.flatnonzero(tests.whole & (ranges[-1][1] > ranges[-1][0]))
    jobs = [(full, ranges[-1], shard.levels[-1][2], np.full(len(full), window))]
    for q in tests.short:  # one lookup per short item, at the deepest level it fills
        size = int(tests.end[q] - q)
        if size >= 3:
            depth, level = 3, 0
            while level + 1 < len(shard.levels) and depth + shard.levels[level + 1][0] <= size:
                level += 1
                depth += shard.levels[level][0]
            low, high = ranges[level][0][q], ranges[level][1][q]
        else:
            level, keys = 0, shard.levels[0][1]
            cut = np.uint64(42 if size == 1 else 21)
            key = (_three(tests.names[q : q + size], np.full(size, size))[0] >> cut) << cut
            low = np.searchsorted(keys, key, "left")
            high = np.searchsorted(keys, key | ((np.uint64(1) << cut) - np.uint64(1)), "right")
        if high > low:
            one = np.array([q])
            jobs.append((one, ({int(q): low}, {int(q): high}), shard.levels[level][2], np.array([size])))
    for q, (low, high), order, size in jobs:
        low, high = (np.array([x[int(i)] for i in q], np.int64) if isinstance(x, dict) else x[q] for x in (low, high))
        total = np.cumsum(high - low)
        begin = 0
        while begin < len(q):
            top = (total[begin - 1] if begin else 0) + PAIRS
            stop = max(begin + 1, int(np.searchsorted(total, top, "right")))
            for a, b in _pieces(low[begin:stop], high[begin:stop]):
                pos = order[K.ragged(a, b - a)]
                test = np.repeat(q[begin:stop], b - a)
                words = np.repeat(size[begin:stop], b - a)
                ok = pos + words <= shard.end[pos]
                pos, test, words = pos[ok], test[ok], words[ok]
                for k in range(int(words.max()) if len(words) else 0):
                    inside = k < words
                    same = ~inside
                    same[inside] = shard.names[pos[inside] + k] == tests.names[test[inside] + k]
                    if not same.all():
                        pos, test, words = pos[same], test[same], words[same]
                yield test, pos, words
            begin = stop


def _pieces(low: np.ndarray, high: np.ndarray):
    """One range per suffix; a single long range in pieces of ``PAIRS``."""
    if len(low) > 1 or high[0] - low[0] <= PAIRS:
        yield low, high
        return
    for a in range(int(low[0]), int(high[0]), PAIRS):
        yield np.array([a]), np.array([min(a + PAIRS, int(high[0]))])


def _longest(tests: Tests, test, pos, words, doc_of):
    """Adjoining windows joined; the longest match of each document and item."""
    item, diagonal = tests.item[test], pos - test
    order = np.lexsort((pos, diagonal, item))
    item, diagonal, pos, test, words = (x[order] for x in (item, diagonal, pos, test, words))
    fresh = K.group_starts(item, diagonal, pos - np.arange(len(pos)), doc_of[pos])
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(pos)) - 1
    size = pos[last] + words[last] - pos[at]
    item, pos, test, doc = item[at], pos[at], test[at], doc_of[pos[at]]
    order = np.lexsort((pos, -size, item, doc))
    item, pos, test, doc, size = (x[order] for x in (item, pos, test, doc, size))
    keep = K.group_starts(doc, item)
    return doc[keep], item[keep], pos[keep], test[keep], size[keep]


def _scan(ids: list, texts: list, window: int, merge: bool, field: int):
    def run(batches):
        tests = Tests(texts, window)
        names_of = np.array(ids, object)
        for batch in K.chunks(K.with_texts(batches, field), "text", SHARD_BYTES):
            names, base = _word_names(*K.text_buffer(batch.column("text")))
            shard = SuffixArray(names, base, window) if len(names) else None
            doc_of = np.repeat(np.arange(batch.num_rows), np.diff(base))
            change = np.zeros(len(names) + 1, np.int64)
            found = []
            if shard is not None:
                for test, pos, words in _matches(shard, tests):
                    np.add.at(change, pos, 1)
                    np.add.at(change, pos + words, -1)
                    found.append((test, pos, words))
            if merge:
                spans = batch.column("hits")
                at = np.asarray(spans.offsets)
                doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
                flat = spans.flatten()
                for name, step in (("start", 1), ("stop", -1)):
                    np.add.at(change, base[doc] + np.asarray(flat.field(name)), step)
            mask = np.cumsum(change[:-1]) > 0
            if found:
                doc, item, pos, test, size = _longest(tests, *(np.concatenate(x) for x in zip(*found)), doc_of)
                listed = np.array([names_of[i] is not None for i in item], bool)
                doc, item, pos, test, size = (x[listed] for x in (doc, item, pos, test, size))
            else:
                doc = item = pos = test = size = np.zeros(0, np.int64)
            matches = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))]).astype(np.int32)),
                pa.StructArray.from_arrays(
                    [
                        pa.array(list(names_of[item]), pa.string()),
                        pa.array(pos - base[doc], pa.int64()),
                        pa.array(test - tests.base[item], pa.int64()),
                        pa.array(size, pa.int64()),
                    ],
                    names=["item_id", "start", "item_start", "n_words"],
                ),
            )
            if merge:
                matches = pa.array([a + b for a, b in zip(batch.column("matches").to_pylist(), matches.to_pylist())], matches.type)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.diff(base), pa.int64()), span_lists(mask, base), matches],
                names=["row", "n_words", "hits", "matches"],
            )

    return run


def verbatim_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (runs of hit words) and ``matches``.

    ``matches`` has the longest verbatim match of each item that occurs: item id, first
    word in the document and in the item, and number of words.  Runs one small job
    to size and fetch the benchmark.
    """
    if window < 4:
        raise ValueError("window must be 4 words or more")
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-int(total) // block_bytes))
    results = ("n_words", "hits", "matches")
    carried = [c for c in docs.columns if c not in results or c == text_col]
    row = T.StructType([docs.schema[c] for c in carried])
    schema = T.StructType([T.StructField("row", row), T.StructField("n_words", T.LongType()), T.StructField("hits", SPANS), T.StructField("matches", MATCHES)])
    now = docs.select(F.struct(*carried).alias("row"))
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        got = part.collect()  # at most about block_bytes: see blocks
        now = now.mapInArrow(K.tidy(_scan([r["item"] for r in got], [r["text"] for r in got], window, b > 0, carried.index(text_col))), schema)
        if b + 1 < blocks:
            now = stored(now, "decontam")
    return now.select(*[F.col("row")[c].alias(c) for c in carried if c not in results], *results)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    found = verbatim_matches(docs, benchmark, **options)
    return found.where(F.size("hits") == 0).select(docs.columns)


@query
def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document's hit words and the items that occur in it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = verbatim_matches(docs, bench)
    n_hit = F.aggregate(F.transform("hits", lambda s: s["stop"] - s["start"]), F.lit(0).cast("long"), lambda a, x: a + x)
    ids = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
