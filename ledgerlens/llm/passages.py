"""Carrying packed passages to buckets and the spans found there back to their documents.

Shared by the two operators that remove repeated passages.  Both cut a document
into strings that cover all its windows, send each string to the bucket of a
content-defined seed inside it (a minimiser), and compare windows there: equal
windows have equal seeds, so they always meet.  The operators differ in what a
token is and in how a bucket compares windows.

* ``Cutter.cut(chunk)`` gives the strings of a chunk of documents.  Of equal
  strings in one chunk only those of the smallest document travel; the others are
  known to be repeats at once.  A passage that a third of all documents share
  therefore sends one string per chunk to its bucket, not one per document.
* ``resolve`` in the bucket drops seeds of a single document and strings whose seed has
  no equal context in another document, settles strings that are equal as a whole, and
  hands only the rest to the operator window by window.
* Spans travel to the partition of their document as packed arrays and are merged
  there with the texts, chunk by chunk.

One row carries all strings of one chunk for one bucket, so rows are few and their
number per bucket does not depend on how often a string repeats.  Nothing is kept
on the driver; each step is a plain shuffle that Spark can recompute.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm import kernels as K

#: A null id counts as larger than every other.
NO_ID = 2**63 - 1
#: Windows that a bucket compares at a time (or one seed's windows, if more).
RESOLVE_WINDOWS = 1 << 18
#: Low bits of a minimiser value that hold its position (windows hold fewer seeds than 64).
_POS = np.uint64(63)


@dataclass
class Strings:
    """Strings of consecutive windows: whose they are, where, and how many windows."""

    id: np.ndarray  # int64
    tag: np.ndarray  # int32, tells apart rows that share an id
    start: np.ndarray  # first token in the document
    windows: np.ndarray
    seed_at: np.ndarray  # token of the seed relative to start

    def take(self, at) -> "Strings":
        return Strings(self.id[at], self.tag[at], self.start[at], self.windows[at], self.seed_at[at])


def home_of(ids: np.ndarray, n: int) -> np.ndarray:
    """The partition of a document; ``home_column`` is the same in Spark."""
    return np.mod(np.mod(np.mod(ids, 2147483647) * 1103515245, 2305843009213693951), n)


def home_column(ids, n: int):
    return F.pmod(
        F.pmod(F.pmod(ids, F.lit(2147483647)) * F.lit(1103515245), F.lit(2305843009213693951)), F.lit(n)
    ).cast("int")


def minimiser_runs(seeds: np.ndarray, per_window: int, valid: np.ndarray):
    """Runs of consecutive windows with the same minimiser.

    ``seeds``: a mixed name per seed position; a window holds ``per_window`` seeds;
    ``valid``: whether a window starts at the position.  Returns the first window of
    each run, the number of windows, the seed's position after the first window's
    start and the seed value.
    """
    n = len(seeds) - per_window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, np.zeros(0, np.uint64)
    marked = (seeds & ~_POS) | (np.arange(len(seeds), dtype=np.uint64) & _POS)
    least = K.sliding_min(marked, per_window)
    valid = valid[:n]
    value = least >> np.uint64(6)
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (value[1:] != value[:-1])
    starts = np.flatnonzero(fresh)
    stops = np.flatnonzero(valid & np.concatenate([fresh[1:] | ~valid[1:], [True]])) + 1
    at = ((least[starts] - starts.astype(np.uint64)) & _POS).astype(np.int64)
    return starts, stops - starts, at, value[starts]


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=5).compress(b"".join(a.tobytes() for a in arrays))


def _unpack(blob: bytes, n: int, *kinds) -> list[np.ndarray]:
    raw, out, at = zstandard.ZstdDecompressor().decompress(blob), [], 0
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        out.append(np.frombuffer(raw[at : at + size], kind))
        at += size
    return out


_PARTS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("meta", T.BinaryType()),
        T.StructField("packed", T.BinaryType()),
    ]
)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    part, n, meta, packed = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(n, pa.int32()), pa.array(meta, pa.binary()), pa.array(packed, pa.binary())],
        names=["part", "n", "meta", "packed"],
    )


def _span_rows(ids, tags, starts, stops, n_parts: int) -> list[tuple]:
    """Spans packed by the home partition of their document, as differences of sorted ids."""
    home = home_of(ids, n_parts)
    order = np.lexsort((starts, tags, ids, home))
    edges = np.flatnonzero(K.group_starts(home[order]))
    return [
        (int(home[at[0]]), len(at), _pack(np.diff(ids[at], prepend=0), tags[at], starts[at].astype(np.int32), (stops - starts)[at].astype(np.int32)), None)
        for at in np.split(order, edges[1:])
        if len(at)
    ]


@dataclass
class Method:
    """What an operator brings: its window, its cut of a chunk, and its comparison."""

    window: int
    #: (buffer, offsets) -> (minimiser runs, tokens' bytes: buffer, first byte of each token, end of each token)
    cut: Callable
    #: (packed bytes, offsets of the strings) -> (token values, first token of each string)
    read: Callable
    #: tokens of a seed
    size: int
    #: token values -> seed name from each token on (without the last ones, which are too short)
    seeds: Callable
    #: (token values, first token, windows, owner ids, seed) -> least id per window
    least: Callable


def _cut_chunks(method: Method, n_parts: int):
    def run(batches):
        for batch in K.chunks(batches, "text"):
            buf, offsets = K.text_buffer(batch.column("text"))
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tag"))
            (starts, windows, at, value), (raw, first_byte, end_byte, base) = method.cut(buf, offsets)
            if not len(starts):
                continue
            doc = np.searchsorted(base, starts, side="right") - 1
            s = Strings(ids[doc], tags[doc].astype(np.int32), starts - base[doc], windows, at)
            last = starts + windows + method.window - 2  # last token
            low, size = first_byte[starts], end_byte[last] - first_byte[starts]
            name = K.slice_names(K.BYTE_NAMES[0][raw], low, low + size)
            other = K.slice_names(K.BYTE_NAMES[1][raw], low, low + size, 1)
            order = np.lexsort((s.id, other, name))
            fresh = K.group_starts(name[order], other[order])
            least = s.id[order][np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
            repeat = s.id[order] > least
            rows = []
            if repeat.any():
                r = s.take(order[repeat])
                rows += _span_rows(r.id, r.tag, r.start, r.start + r.windows + method.window - 1, n_parts)
            keep = order[~repeat]
            part = (K.mix(value[keep]) % np.uint64(n_parts)).astype(np.int64)
            by_part = np.lexsort((keep, part))
            keep, part = keep[by_part], part[by_part]
            for group in np.split(np.arange(len(keep)), np.flatnonzero(K.group_starts(part))[1:]):
                at_ = keep[group]
                g = s.take(at_)
                rows.append(
                    (
                        int(part[group[0]]),
                        len(at_),
                        _pack(g.id, g.tag, g.start.astype(np.int32), g.windows.astype(np.int32), size[at_].astype(np.int32), g.seed_at.astype(np.uint8)),
                        _pack(raw[K.ragged(low[at_], size[at_])]),
                    )
                )
            yield _rows(rows)

    return run


def _least_of_groups(order_keys: tuple[np.ndarray, ...], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least id of each group of equal keys, for every row, and a number for the group."""
    order = np.lexsort((ids, *reversed(order_keys)))
    fresh = K.group_starts(*(k[order] for k in order_keys))
    number = np.cumsum(fresh) - 1
    least, group = np.empty_like(ids), np.empty(len(ids), np.int64)
    least[order] = ids[order][np.flatnonzero(fresh)][number]
    group[order] = number
    return least, group


def _resolve_part(method: Method, n_parts: int):
    def run(batches):
        held: list[tuple] = []  # (token values, first token and windows of each string) of one blob each
        known: list[tuple] = []  # what is compared of the strings: whose, seed and names
        ready: list[tuple] = []
        for batch in batches:
            for part, n, meta, packed in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "meta", "packed"))):
                if packed is None:
                    ready.append((part, n, meta, None))
                    continue
                ids, tags, starts, windows, size, at = _unpack(meta, n, np.int64, np.int32, np.int32, np.int32, np.int32, np.uint8)
                raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
                values, first = method.read(raw, np.concatenate([[0], np.cumsum(size, dtype=np.int64)]))
                first, length = first[:-1], windows.astype(np.int64) + method.window - 1
                seeds = method.seeds(values)
                seed = seeds[first + at]
                names, contexts = _names(method, values, first, length, at)
                several = np.add.reduceat(seeds == np.repeat(seed, length)[: len(seeds)], first, dtype=np.int32) > 1
                held.append((values, first, windows))
                known.append((ids, tags, starts, windows, at, seed, *names, *contexts, several))
            if len(ready) > 256:
                yield _rows(ready)
                ready = []
        if ready:
            yield _rows(ready)
        if not held:
            return
        *whose, seed, name, other, left, right, several = (np.concatenate(c) for c in zip(*known))
        del known
        s = Strings(*whose)
        number = np.cumsum([0] + [len(h[1]) for h in held])

        def tokens(wanted: np.ndarray):
            """The tokens of the wanted strings (sorted), one string after another."""
            cuts = np.searchsorted(wanted, number)
            return np.concatenate(
                [h[0][K.ragged(h[1][at], h[2][at].astype(np.int64) + method.window - 1)] for h, low, a, b in zip(held, number, cuts, cuts[1:]) for at in [wanted[a:b] - low]]
            )

        for found in _resolve(method, s, tokens, seed, name, other, left, right, several):
            for i in range(0, len(found[0]), 1 << 20):
                rows = _span_rows(*(f[i : i + (1 << 20)] for f in found), n_parts)
                if rows:
                    yield _rows(rows)

    return run


#: The context of a seed that is too near the string's end to have one.
_SHORT = np.uint64(0)


def _names(method: Method, values: np.ndarray, first: np.ndarray, length: np.ndarray, at: np.ndarray):
    """Two names of each string, and the names of its seed's context to the left and right.

    A window leaves ``window - size`` tokens around its seed, so on one side at least
    ``reach``, half of them.  Equal windows therefore agree in ``reach`` tokens on a side.
    """
    reach, n = (method.window - method.size + 1) // 2, len(first)
    begin = first + at
    after = begin + method.size
    low = np.concatenate([first, np.maximum(begin - reach, first), after])
    high = np.concatenate([first + length, begin, np.minimum(after + reach, first + length)])
    one, left, right = np.split(K.slice_names(_as_values(values, 0), low, high), [n, 2 * n])
    two = K.slice_names(_as_values(values, 1), first, first + length, 1)
    return (one, two), (np.where(at >= reach, left | np.uint64(1), _SHORT), np.where(at + method.size + reach <= length, right | np.uint64(1), _SHORT))


def _meets(seed: np.ndarray, context: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether a string of another document has the same seed with the same context."""
    out = np.zeros(len(seed), bool)
    rows = np.flatnonzero(context != _SHORT)
    if not len(rows):
        return out
    key = K.mix(K.mix(seed[rows]) + context[rows])
    order = np.argsort(key)
    at = np.flatnonzero(K.group_starts(key[order]))
    who = ids[rows][order]
    low, high = np.minimum.reduceat(who, at), np.maximum.reduceat(who, at)
    out[rows[order]] = np.repeat(low != high, np.diff(np.append(at, len(order))))
    return out


def _as_values(values: np.ndarray, which: int) -> np.ndarray:
    return K.BYTE_NAMES[which][values] if values.dtype == np.uint8 else values


def _resolve(method: Method, s: Strings, tokens, seed, name, other, left, right, several):
    """Spans (ids, tags, starts, stops) of the windows that a smaller id has too.

    ``several``: strings that hold their seed more than once.  Which of its places stands
    for a window is then a matter of chance, so all strings of such a seed are compared.
    """
    cover = method.window - 1
    # 1. seeds of one document only repeat nothing
    order = np.argsort(seed, kind="stable")
    fresh = K.group_starts(seed[order])
    at = np.flatnonzero(fresh)
    low, high = np.minimum.reduceat(s.id[order], at), np.maximum.reduceat(s.id[order], at)
    alive = order[np.repeat(low != high, np.diff(np.append(at, len(order))))]
    if not len(alive):
        return
    # 2. strings whose seed has no equal context in another document repeat nothing either
    at = np.flatnonzero(K.group_starts(seed[alive]))
    unclear = np.repeat(np.logical_or.reduceat(several[alive], at), np.diff(np.append(at, len(alive))))
    alive = alive[unclear | _meets(seed[alive], left[alive], s.id[alive]) | _meets(seed[alive], right[alive], s.id[alive])]
    if not len(alive):
        return
    # 3. strings that are equal as a whole
    least, group = _least_of_groups((seed[alive], name[alive], other[alive]), s.id[alive])
    whole = s.id[alive] > least
    w = s.take(alive[whole])
    if len(w.id):
        yield w.id, w.tag, w.start, w.start + w.windows + cover
        del w
    rest, group = alive[~whole], group[~whole]
    # groups are numbered in order of their seed; one string stands for each
    group_first = np.unique(group, return_index=True)[1]
    stands = rest[group_first]
    several = K.group_starts(seed[stands])
    size = np.diff(np.append(np.flatnonzero(several), len(stands)))
    open_ = np.repeat(size > 1, size)
    stands = stands[open_]
    if not len(stands):
        return
    # 4. window by window, some seeds at a time; every string takes its group's windows
    number = np.full(int(group.max()) + 1, -1)
    number[group[group_first[open_]]] = np.arange(len(stands))
    which = number[group]
    rest, which = rest[which >= 0], which[which >= 0]
    order = np.argsort(which, kind="stable")
    rest, which = rest[order], which[order]
    seed_edge = np.append(np.flatnonzero(K.group_starts(seed[stands])), len(stands))
    before = np.concatenate([[0], np.cumsum(s.windows[stands], dtype=np.int64)])
    del number, group, order, group_first, open_
    begin = 0
    while begin + 1 < len(seed_edge):
        a = seed_edge[begin]
        stop = max(begin + 1, int(np.searchsorted(before[seed_edge], before[a] + RESOLVE_WINDOWS, side="right")) - 1)
        b = seed_edge[stop]
        m = stands[a:b]
        wanted = np.argsort(m)
        windows = s.windows[m].astype(np.int64)
        length = windows + cover
        first = np.empty(len(m), np.int64)
        first[wanted] = np.cumsum(length[wanted]) - length[wanted]
        least_of = method.least(tokens(m[wanted]), first, windows, s.id[m], seed[m])
        lo, hi = np.searchsorted(which, [a, b])
        yield _flagged(s.take(rest[lo:hi]), before[which[lo:hi]] - before[a], least_of, cover)
        begin = stop


def _flagged(r: Strings, at: np.ndarray, least_of: np.ndarray, cover: int):
    """The spans of the strings' windows whose least id (from ``at`` on) is smaller than theirs."""
    windows = r.windows.astype(np.int64)
    flags = least_of[K.ragged(at, windows)] < np.repeat(r.id, windows)
    first = np.cumsum(windows) - windows
    edge = np.zeros(len(flags) + 1, bool)
    edge[first] = edge[-1] = True
    i = np.flatnonzero(flags & (edge[:-1] | ~np.concatenate([[False], flags[:-1]])))
    j = np.flatnonzero(flags & (edge[1:] | ~np.concatenate([flags[1:], [False]])))
    owner = np.searchsorted(first, i, side="right") - 1
    start = r.start[owner] + i - first[owner]
    return r.id[owner], r.tag[owner], start, start + (j - i) + 1 + cover


def partitions(spark) -> int:
    """Twice the session's shuffle partitions: a bucket is held in the task's Python memory."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _compress_texts(batches):
    """Documents on the way to their partition: texts packed one by one (null: null)."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [t.as_buffer() for t in batch.column("text")]
        packed = pa.array([t if t is None else press.compress(t) for t in packed], pa.binary())
        yield pa.RecordBatch.from_arrays([packed if c == "text" else batch.column(c) for c in batch.schema.names], names=batch.schema.names)


def repeated_spans(
    docs: DataFrame, method: Method, id_col: str, text_col: str, finish, fields: list[T.StructField], keep_text: bool = True
) -> DataFrame:
    """``docs`` with the columns that ``finish`` makes of each chunk's texts and spans.

    ``finish(buffer, offsets, cover)`` returns one Arrow array per field; ``cover(base)``
    gives a mask of removed tokens from the first token of each document.  Without
    ``keep_text`` the text column is left out of the result.
    """
    n = partitions(docs.sparkSession)
    names = [f.name for f in fields]
    others = [c for c in docs.columns if c not in names and c != text_col]
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    keyed = docs.select(
        home_column(ids, n).alias("home"),
        F.lit(-1).alias("n"),
        ids.alias("id"),
        F.coalesce(F.hash(F.col(text_col)), F.lit(0)).alias("tag"),
        F.col(text_col).cast("string").alias("text"),
        F.struct(*[F.col(c) for c in others]).alias("row"),
    )
    parts = keyed.select("id", "tag", "text").mapInArrow(K.tidy(_cut_chunks(method, n)), _PARTS)
    spans = parts.repartitionById(n, "part").mapInArrow(K.tidy(_resolve_part(method, n)), _PARTS)
    schema = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == "text" else f.dataType) for f in keyed.schema])
    packed = keyed.mapInArrow(K.tidy(_compress_texts), schema)
    left = spans.select(F.col("part").alias("home"), "n", F.col("meta").alias("text"))
    joined = packed.unionByName(left, allowMissingColumns=True).repartitionById(n, "home").sortWithinPartitions(F.col("n") < 0)
    kept = [T.StructField(text_col, T.StringType())] if keep_text and text_col not in names else []
    out = T.StructType([T.StructField("row", schema["row"].dataType), *kept, *fields])
    result = joined.mapInArrow(K.tidy(_apply_spans(finish, out.names, bool(kept))), out)
    columns = [text_col if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c in others or c == text_col and kept]
    return result.select(*columns, *names)


class _Held:
    """The spans of one partition, found by document."""

    def __init__(self, blobs: list[tuple[int, bytes]]):
        cols = [_unpack(m, n, np.int64, np.int32, np.int32, np.int32) for n, m in blobs]
        if cols:
            self.id, self.tag, self.start, self.stop = (np.concatenate(c) for c in zip(*((np.cumsum(i), t, a, a + d) for i, t, a, d in cols)))
        else:
            self.id, (self.tag, self.start, self.stop) = np.zeros(0, np.int64), (np.zeros(0, np.int32),) * 3
        order = np.lexsort((self.tag, self.id))
        self.id, self.tag, self.start, self.stop = (x[order] for x in (self.id, self.tag, self.start, self.stop))

    def cover(self, ids: np.ndarray, tags: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Mask of covered tokens; ``base``: first token of each document and the total."""
        lo, hi = np.searchsorted(self.id, ids, "left"), np.searchsorted(self.id, ids, "right")
        doc = np.repeat(np.arange(len(ids)), hi - lo)
        at = K.ragged(lo, hi - lo)
        same = self.tag[at] == tags[doc]
        doc, at = doc[same], at[same]
        change = np.zeros(int(base[-1]) + 1, np.int32)
        np.add.at(change, base[doc] + self.start[at], 1)
        np.add.at(change, base[doc] + self.stop[at], -1)
        return np.cumsum(change[:-1]) > 0


def _texts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with its texts unpacked."""
    press = zstandard.ZstdDecompressor()
    texts = pa.array([t if t is None else press.decompress(t) for t in batch.column("text").to_pylist()], pa.binary())
    return batch.set_column(batch.schema.get_field_index("text"), "text", texts.cast(pa.string()))


def _apply_spans(finish, names: list[str], with_text: bool):
    def run(batches):
        blobs: list[tuple[int, bytes]] = []
        held = None
        for batch in batches:
            is_doc = np.asarray(batch.column("n").to_numpy(zero_copy_only=False)) < 0
            if not is_doc.all():
                side = batch.filter(pa.array(~is_doc))
                blobs += zip(side.column("n").to_pylist(), side.column("text").to_pylist())
                batch = batch.filter(pa.array(is_doc))
            if batch.num_rows and held is None:
                held, blobs = _Held(blobs), []
            for part in range(0, batch.num_rows, 256):
                for piece in K.chunks([_texts(batch.slice(part, 256))], "text"):
                    buf, offsets = K.text_buffer(piece.column("text"))
                    ids, tags = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tag"))
                    arrays = finish(buf, offsets, lambda base: held.cover(ids, tags, base))
                    text = [piece.column("text")] if with_text else []
                    yield pa.RecordBatch.from_arrays([piece.column("row"), *text, *arrays], names=names)

    return run


def per_doc(counts: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Sums of ``counts`` over each document's tokens."""
    total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    return total[base[1:]] - total[base[:-1]]


def span_lists(mask: np.ndarray, base: np.ndarray) -> pa.Array:
    """The maximal removed runs of each document as lists of (start, stop) tokens."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[base] = True
    n = len(mask)
    begin = np.flatnonzero(mask & (edge[:n] | ~np.concatenate([[False], mask[:-1]])[:n])) if n else np.zeros(0, np.int64)
    end = np.flatnonzero(mask & (edge[1:] | ~np.concatenate([mask[1:], [False]])[:n])) + 1 if n else np.zeros(0, np.int64)
    doc = np.searchsorted(base, begin, side="right") - 1
    counts = np.bincount(doc, minlength=len(base) - 1) if len(base) > 1 else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    items = pa.StructArray.from_arrays([pa.array(begin - base[doc], pa.int64()), pa.array(end - base[doc], pa.int64())], names=["start", "stop"])
    return pa.ListArray.from_arrays(pa.array(offsets), items)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
