"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates.

Features of a whole text are the relative frequencies of its word unigrams and bigrams
and of the same n-grams of word shapes (letter case, digits and punctuation with runs
collapsed; a shape bigram also says whether both words are the same), hashed into
``2**BITS`` places.  Nothing but the text enters: no label, language, source or id.

Training reads labelled rows only.  At most about ``sample_rows`` of them, chosen by a
hash of the id, are turned into sparse rows by all executors and fed to
follow-the-regularised-leader updates in one task: a bound on both its input and
the model (two arrays of ``2**BITS`` numbers).  The weights go to every task, and a
score is one sparse dot product through the logistic function.

Definitions: null text is empty; a text without words scores the logistic of the bias
alone; labels of an id that occur more than once count once, by the lowest; labels
without id or class are ignored; without any label every score is 0.5; repeated rows
are scored each; columns named like a result column are replaced; empty tables give
empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm import kernels as K, query

BITS = 18
#: Labelled rows used for training (about; chosen by hash).
SAMPLE_ROWS = 20000
#: Score from which a document counts as good.
GOOD = 0.7

#: FTRL-proximal: learning rate, its smoothing, L1 and L2 strength, and passes.
ALPHA, BETA, L1, L2, PASSES = 1.0, 1.0, 1e-4, 1e-4, 4

_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[ord("a") : ord("z") + 1] = ord("a")
_SHAPES[ord("A") : ord("Z") + 1] = ord("A")
_SHAPES[ord("0") : ord("9") + 1] = ord("0")
_SHAPES[0x80:] = ord("a")


def features(buf: np.ndarray, offsets: np.ndarray):
    """(places, weights, documents) of all n-grams: one entry for each occurrence."""
    starts, ends, base = K.token_spans(buf, offsets)
    n = len(starts)
    doc = np.repeat(np.arange(len(base) - 1), np.diff(base))
    shapes = _SHAPES[buf]
    keep = np.ones(len(buf), bool)
    keep[1:] = shapes[1:] != shapes[:-1]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    words = K.token_names(buf, starts, ends)
    shape = K.token_names(shapes[keep], at[starts], at[ends])
    pair = np.flatnonzero(doc[1:] == doc[:-1]) if n > 1 else np.zeros(0, np.int64)
    same = (words[pair] == words[pair + 1]).astype(np.uint64)
    size = np.maximum(np.diff(base), 1)
    one, two = 1.0 / size[doc], 1.0 / np.maximum(size - 1, 1)[doc[pair]]
    names = [
        words,
        K.mix(words[pair] * np.uint64(3) + words[pair + 1]),
        K.mix(shape + np.uint64(7)),
        K.mix(shape[pair] * np.uint64(5) + shape[pair + 1] * np.uint64(2) + same),
    ]
    places = np.concatenate([(x >> np.uint64(64 - BITS)).astype(np.int64) for x in names])
    return places, np.concatenate([one, two, one, two]), np.concatenate([doc, doc[pair], doc, doc[pair]])


def _sparse(batches):
    for batch in K.chunks(batches, "text"):
        places, weights, doc = features(*K.text_buffer(batch.column("text")))
        key = (doc << BITS) | places
        order = np.argsort(key, kind="stable")
        fresh = np.flatnonzero(K.group_starts(key[order]))
        value = np.add.reduceat(weights[order], fresh) if len(fresh) else weights
        key = key[order][fresh]
        cuts = np.searchsorted(key >> BITS, np.arange(batch.num_rows + 1))
        place = (key & ((1 << BITS) - 1)).astype(np.int32)
        value = value.astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("turn"),
                batch.column("label"),
                pa.array([place[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                pa.array([value[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            ],
            names=["turn", "label", "places", "freqs"],
        )


class Ftrl:
    """Follow-the-regularised-leader (proximal) with a learning rate per weight."""

    def __init__(self):
        self.z, self.n = np.zeros(1 + (1 << BITS)), np.zeros(1 + (1 << BITS))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def update(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _train(batches):
    """All rows of the bounded sample, in the order of their hash, ``PASSES`` times."""
    rows = []
    for batch in batches:
        rows += zip(*(batch.column(c).to_pylist() for c in ("turn", "label", "places", "freqs")))
    rows.sort(key=lambda r: (r[0], r[2]))
    model = Ftrl()
    bias = 1 << BITS
    for _ in range(PASSES):
        for _, label, places, freqs in rows:
            at = np.append(np.frombuffer(places, np.int32), bias)
            model.update(at, np.append(np.frombuffer(freqs, np.float32), 1.0), label)
    yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype(np.float32).tobytes()], pa.binary())], names=["weights"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> bytes:
    """The model's weights (float32, the bias last).  Runs jobs; the result has a fixed size."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg(F.min(label_col).cast("int").alias("label"))
    total = known.count()
    part = 1 << 30
    turn = F.pmod(F.xxhash64("key"), F.lit(part))
    share = min(1.0, sample_rows / max(total, 1))
    sample = known.withColumn("turn", turn).where(F.col("turn") < int(part * share))
    # about sample_rows rows of three numbers: small by the bound on the sample
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(sample), "key")
    sparse = rows.select("turn", "label", "text").mapInArrow(K.tidy(_sparse), "turn long, label int, places binary, freqs binary")
    return bytes(sparse.repartition(1).mapInArrow(K.tidy(_train), "weights binary").first()["weights"])


def _score(weights: bytes, at: int):
    def run(batches):
        w = np.frombuffer(weights, np.float32).astype(np.float64)
        for batch in K.chunks(K.with_texts(batches, at), "text", K.CHUNK_BYTES // 2):
            places, freqs, doc = features(*K.text_buffer(batch.column("text")))
            dot = np.bincount(doc, w[places] * freqs, minlength=batch.num_rows) + w[-1]
            score = 1 / (1 + np.exp(-np.clip(dot, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score)], names=["row", "score"])

    return run


def score(docs: DataFrame, weights: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``: the estimated chance that the text is good."""
    carried = [c for c in docs.columns if c != "score" or c == text_col]
    row = T.StructType([docs.schema[c] for c in carried])
    schema = T.StructType([T.StructField("row", row), T.StructField("score", T.DoubleType())])
    scored = docs.select(F.struct(*carried).alias("row")).mapInArrow(K.tidy(_score(weights, carried.index(text_col))), schema)
    return scored.select(*[F.col("row")[c].alias(c) for c in carried if c != "score"], "score")


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are kept for evaluation: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query
def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Every document's quality score and class."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    found = score(docs, train(docs, labels))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
