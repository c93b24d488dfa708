"""Repeated word windows by super-k-mer partitioning.

Every window of 13 words has a minimiser: the least-hashed run of ``SEED`` words in
it.  Consecutive windows of a document with the same minimiser form a super-k-mer,
which travels as one packed string (its words joined by one space) to the
minimiser's bucket.  In the bucket the strings are split into windows again, and a
sort of the window names (128 bits of the exact words) puts equal windows together
with the smallest document of each.  Equal windows share their minimiser, so each is
judged in exactly one bucket, against all of its copies.

Definitions: null text has no words; texts shorter than a window keep everything; a
null id counts as larger than every other; rows that share an id never take words
from one another; columns named like a result column are replaced; empty tables give
empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm import kernels as K, passages as P, query

#: Words of a minimiser.
SEED = 3


def _words(buf: np.ndarray, offsets: np.ndarray):
    """Word names, the bytes of all words with one space after each, and token bounds."""
    starts, ends, base = K.token_spans(buf, offsets)
    size = ends - starts + 1
    at = np.concatenate([[0], np.cumsum(size)])
    joined = buf[np.minimum(K.ragged(starts, size), max(len(buf) - 1, 0))]
    joined[at[1:] - 1] = 0x20
    return K.token_names(buf, starts, ends), joined, at, base


def _cut(window: int):
    def cut(buf, offsets):
        names, joined, at, base = _words(buf, offsets)
        seeds = K.window_names(names, SEED)
        valid = np.ones(len(names), bool)
        for b, e in zip(base[:-1], base[1:]):
            valid[max(b, e - window + 1) : e] = False
        return P.minimiser_runs(seeds, window - SEED + 1, valid), (joined, at[:-1], at[1:] - 1, base)

    return cut


def _read(raw, offsets):
    starts, ends, base = K.token_spans(raw, offsets)
    return K.token_names(raw, starts, ends), base


def _seeds(names):
    return K.window_names(names, SEED)


def _least(window: int):
    def least(names, first, windows, ids, seed):
        """Least id per window, by sorting the windows' names."""
        length = windows + window - 1
        words = names[K.ragged(first, length)]
        at = K.ragged(np.cumsum(length) - length, windows)
        one, two = (K.slice_names(words, at, at + window, w) for w in (0, 1))
        return P._least_of_groups((one, two), np.repeat(ids, windows))[0]

    return least


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (removed runs of words) and ``kept`` (text).

    A word is removed if a window of ``window`` consecutive words covering it also
    starts in a document with a smaller id; ``kept`` joins the others by one space.
    """
    if not SEED < window <= 63 + SEED:
        raise ValueError(f"window must be {SEED + 1} to {63 + SEED} words")
    method = P.Method(window, _cut(window), _read, SEED, _seeds, _least(window))

    def finish(buf, offsets, cover):
        _, joined, at, base = _words(buf, offsets)
        mask = cover(base)
        size = np.diff(at)
        data = joined[np.repeat(~mask, size)]
        ends = np.concatenate([[0], np.cumsum(P.per_doc(np.where(mask, 0, size), base))])
        # the space after a document's last kept word goes
        filled = ends[1:] > ends[:-1]
        data = np.delete(data, ends[1:][filled] - 1)
        ends[1:] -= np.cumsum(filled)
        text = pa.LargeStringArray.from_buffers(len(base) - 1, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))
        return [pa.array(np.diff(base), pa.int64()), P.span_lists(mask, base), text.cast(pa.string())]

    fields = [T.StructField("n_words", T.LongType()), T.StructField("spans", P.SPANS), T.StructField("kept", T.StringType())]
    return P.repeated_spans(docs, method, id_col, text_col, finish, fields, keep_text)


@query
def op6_superkmer_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's words, removed words and the digest of the kept ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    removed = F.aggregate(F.transform("spans", lambda s: s["stop"] - s["start"]), F.lit(0).cast("long"), lambda a, x: a + x)
    return repeated_words(docs, keep_text=False).select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
