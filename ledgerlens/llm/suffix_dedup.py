"""Exact removal of repeated byte strings by distributed prefix doubling.

A byte position is a suffix; its rank by the first ``h`` bytes is refined at growing
offsets until it is unique or ``h`` has passed the threshold (50 bytes):

1. *First rank, across the cluster.*  The rank by ``SEED`` bytes is computed at every
   position, and the positions of the least rank of each threshold-long window (its
   minimisers) are shuffled by Spark to the partition of that rank.  A position
   travels with the stretch of windows it stands for, so the windows need no rows of
   their own.  Equal windows have equal least ranks and always meet.
2. *Unique ranks end.*  In the partition, positions are sorted by rank; ranks of a
   single document are dropped (most of them), then positions whose rank is unique once
   it takes in the half window before or after them; stretches that are equal as a
   whole are settled at once.
3. *Growing offsets.*  The windows left are ranked by (rank of the first ``h`` bytes,
   name of the following bytes) with ``h`` = 16, 32, ... up to the threshold; each round
   sorts the pairs, gives new ranks and drops positions whose rank has become unique.

Later rounds compare positions of one first rank only and therefore stay in its
partition: one shuffle instead of one for each offset, which at eight bytes a rank and
position would be many times the input.

Definitions: null text is empty; texts shorter than the threshold keep everything;
a null id counts as larger than every other; rows that share an id never take
anything from one another (only a *smaller* id does); columns named like a result
column are replaced; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm import kernels as K, passages as P, query

#: Bytes of the first rank (one 64-bit number).
SEED = 8


def _eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number (zeros after the end)."""
    x = np.zeros(len(buf) + 8, np.uint64)
    x[: len(buf)] = buf
    for shift in (1, 2, 4):
        y = x << np.uint64(8 * shift)
        y[:-shift] |= x[shift:]
        x = y
    return x


def _cut(window: int):
    def cut(buf, offsets):
        n = len(buf)
        seeds = K.mix(_eights(buf)[:n])
        valid = np.ones(n, bool)
        for e, b in zip(offsets[1:], offsets[:-1]):
            valid[max(b, e - window + 1) : e] = False
        found = P.minimiser_runs(seeds[: max(0, n - SEED + 1)], window - SEED + 1, valid)
        at = np.arange(n + 1)
        return found, (buf, at[:-1], at[1:], offsets)

    return cut


def _read(raw, offsets):
    return raw, offsets


def _seeds(raw):
    return _eights(raw)[: max(0, len(raw) - SEED + 1)]


def _least(window: int):
    def least(raw, first, windows, ids, seed):
        """Least id per window: rank pairs at growing offsets, unique ranks dropped."""
        length = windows + window - 1
        buf = raw[K.ragged(first, length)]
        eights = _eights(buf)
        start = np.cumsum(length) - length
        at = K.ragged(start, windows)  # window starts in buf
        owner = np.repeat(ids, windows)
        out = owner.copy()
        rank = np.repeat(np.cumsum(K.group_starts(seed)).astype(np.uint64), windows)
        live = np.arange(len(at))
        h = 0
        while h < window and len(live):
            step = min(16, window - h)
            p = at[live] + h
            if step > 8:
                pair = K.mix(K.mix(eights[p]) + eights[p + step - 8])
            else:
                pair = eights[p] >> np.uint64(64 - 8 * step)
            key = K.mix(K.mix(rank[live]) + pair)
            order = np.argsort(key)
            fresh = K.group_starts(key[order])
            edge = np.flatnonzero(fresh)
            who = owner[live][order]
            low, high = np.minimum.reduceat(who, edge), np.maximum.reduceat(who, edge)
            size = np.diff(np.append(edge, len(order)))
            again = np.repeat(low != high, size)
            h += step
            rank[live[order]] = np.cumsum(fresh).astype(np.uint64)
            if h >= window:
                out[live[order]] = np.repeat(low, size)
            live = live[order][again]
        return out

    return least


def _whole_characters(buf: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The mask without characters of which a byte is kept."""
    if not len(buf):
        return mask
    first = np.flatnonzero((buf & 0xC0) != 0x80)
    size = np.diff(np.append(first, len(buf)))
    return np.repeat(np.logical_and.reduceat(mask, first), size)


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, as_text: bool = False, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_bytes``, ``spans`` (removed runs of bytes) and ``kept`` (binary).

    A byte is removed if a ``window``-byte string covering it also starts in a
    document with a smaller id.  ``kept`` is what remains, in order.  With ``as_text``
    only whole characters go and ``kept`` is a string.
    """
    if not 24 <= window <= 63 + SEED:
        raise ValueError(f"window must be 24 to {63 + SEED} bytes")
    method = P.Method(window, _cut(window), _read, SEED, _seeds, _least(window))

    def finish(buf, offsets, cover):
        mask = cover(offsets)
        if as_text:
            mask = _whole_characters(buf, mask)
        kept = P.per_doc(~mask, offsets)
        ends = np.concatenate([[0], np.cumsum(kept)])
        data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(kept), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(buf[~mask].tobytes())])
        return [pa.array(np.diff(offsets), pa.int64()), P.span_lists(mask, offsets), data.cast(pa.string() if as_text else pa.binary())]

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("spans", P.SPANS), T.StructField("kept", T.StringType() if as_text else T.BinaryType())]
    return P.repeated_spans(docs, method, id_col, text_col, finish, fields, keep_text)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """``docs`` with the repeated passages cut out of their texts (null becomes empty)."""
    found = repeated_bytes(docs, id_col, text_col, window, as_text=True, keep_text=False)
    return found.select(*[F.col("kept").alias(c) if c == text_col else c for c in docs.columns])


def removed_count(spans="spans"):
    """Tokens in a list of spans."""
    return F.aggregate(F.transform(spans, lambda s: s["stop"] - s["start"]), F.lit(0).cast("long"), lambda a, x: a + x)


@query
def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's size, removed bytes, runs and the digest of what it keeps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return repeated_bytes(docs, keep_text=False).select(
        "doc_id",
        "n_bytes",
        removed_count().alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
