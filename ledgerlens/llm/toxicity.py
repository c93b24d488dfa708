"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

Two dictionaries are trained separately with zstandard: one on blocks of ordinary
labelled texts, a small one on windows of toxic texts.  Every window of ``WINDOW``
bytes of a text (one starts each ``STEP`` bytes, so that all bytes are covered) is
compressed twice: by what the ordinary dictionary knows, and by that with the toxic
dictionary added.  The bytes saved by the second are the window's evidence.

Training on windows of whole toxic texts gives a dictionary of ordinary prose, so it is
refined ``ROUNDS`` times: dictionaries of either half of the toxic texts judge the
windows of the other half, and only windows that save more than the share ``QUANTILE`` of
ordinary windows does are trained on next.  The same crossing (no text is judged by a
dictionary that has seen it) gives the figures on which thresholds are calibrated: a text
is described by its mean saving and by how many of its windows save at least 1 to 9
bytes, a logistic curve turns that into a chance, and the chance from which on calling
texts toxic has the best F1 is mapped to the score ``TOXIC``.

Nothing but the text enters a score.  Training is on a bounded sample, in one task: at
most about ``toxic_rows`` and ``ordinary_rows`` labelled rows, chosen by a hash of the id,
and of a training text longer than ``BLOCKS`` blocks of ``BLOCK`` bytes that many blocks
spread evenly over it.  The model has a fixed size (under 300 kB) and goes to every
task; scoring reads every byte of every text.

Definitions: null text is empty; an empty text scores like one whose windows save
nothing; a very long text is compressed block of windows by block, so that beside its
bytes a task holds a bounded number of windows; labels of an id that occur more than
once count once, by the lowest; labels without id or class are ignored; where either class
has no label every score is 0.5; repeated rows are scored each; of columns named like
the result column the new one stays; empty tables give empty results.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm import kernels as K, query

#: Bytes of a window, and from one window's start to the next one's.
WINDOW, STEP = 40, 20
#: Bytes of the ordinary and of the toxic dictionary, and of the segments they are made of.
ORDINARY_BYTES, TOXIC_BYTES = 1 << 18, 1 << 12
ORDINARY_SEGMENT, TOXIC_SEGMENT, MATCH = 200, 16, 8
LEVEL, ROUNDS, QUANTILE = 3, 4, 0.985
#: Labelled rows of either class used for training (about; chosen by hash).
TOXIC_ROWS, ORDINARY_ROWS = 2000, 4000
#: Of a longer training text this many blocks of this many bytes are used.
BLOCKS, BLOCK = 8, 4000
#: Score from which a document counts as toxic.
TOXIC = 0.7
#: Savings whose counts describe a text.
LEVELS = np.arange(1, 10)
#: Windows held at a time.
HELD = 20000


def windows(data: bytes) -> list[bytes]:
    """Windows that cover ``data``: the last is shorter where the bytes end."""
    return [data[i : i + WINDOW] for i in range(0, max(1, len(data) - WINDOW + STEP), STEP)] if data else []


def _trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """A zstandard dictionary of the samples; where they are too few to train one, their own bytes."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=MATCH).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


class Lengths:
    """Compressed lengths of windows, given bytes that the compressor knows."""

    def __init__(self, known: bytes):
        how = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        if known:
            content = zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(LEVEL)
            how["dict_data"] = content
        self.compress = zstandard.ZstdCompressor(**how).compress

    def __call__(self, found: list[bytes]) -> np.ndarray:
        compress = self.compress
        return np.fromiter((len(compress(w)) for w in found), np.int64, len(found))


class Judge:
    """Savings of windows by the toxic dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes, plain: Lengths | None = None):
        self.plain, self.both = plain or Lengths(ordinary), Lengths(ordinary + toxic)

    def savings(self, found: list[bytes]) -> np.ndarray:
        return self.plain(found) - self.both(found)

    def figures(self, data: bytes) -> np.ndarray:
        """What describes a text: mean saving, size, and shares and counts of windows by saving."""
        n, total, counts = 0, 0, np.zeros(len(LEVELS), np.int64)
        for begin in range(0, len(data), HELD * STEP):
            stop = begin + HELD * STEP
            # a block's last window reaches into the next block, where the next window starts anew
            piece = data[begin:] if stop + WINDOW >= len(data) else data[begin : stop + WINDOW - STEP]
            saved = self.savings(windows(piece))
            n, total = n + len(saved), total + int(saved.sum())
            counts += (saved[:, None] >= LEVELS).sum(0)
            if stop + WINDOW >= len(data):
                break
        n = max(n, 1)
        return np.concatenate([[total / n, n**-0.5], counts / n, np.log1p(counts)])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps (the bias last)."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _best_cut(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The chance from which on calling texts toxic has the best F1."""
    order = np.argsort(-p, kind="stable")
    hit, all_ = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
    last = np.append(p[order][1:] != p[order][:-1], True)
    f1 = np.where(last, 2 * hit / (all_ + (weight * y).sum()), -1)
    return float(np.clip(p[order][np.argmax(f1)], 1e-3, 1 - 1e-3))


def fit(rows: list[tuple[int, int, bytes]]) -> dict | None:
    """The model of (order, label, text) rows: dictionaries, scales and weights; None without both classes."""
    rows = sorted(rows)
    toxic, plain = ([r[2] for r in rows if r[1] == label and r[2]] for label in (1, 0))
    if not toxic or not plain:
        return None
    half = max(1, len(plain) // 2)
    ordinary = _trained([t[i : i + 400] for t in plain[:half] for i in range(0, len(t), 400)], ORDINARY_BYTES, ORDINARY_SEGMENT)
    lengths = Lengths(ordinary)
    others = plain[half:] or plain
    every = [w for t in others for w in windows(t)]
    clean = every[:: max(1, len(every) // 60000)]
    folds = [toxic[f::2] or toxic for f in (0, 1)]
    cut = [[w for t in fold for w in windows(t)] for fold in folds]
    now = cut
    for _ in range(ROUNDS):
        chosen = []
        for f in (0, 1):
            judge = Judge(ordinary, _trained(now[1 - f], TOXIC_BYTES, TOXIC_SEGMENT), lengths)
            bar = max(np.quantile(judge.savings(clean), QUANTILE), 1)
            chosen.append([w for w, s in zip(cut[f], judge.savings(cut[f])) if s > bar])
        if not all(chosen):
            break
        now = chosen
    x, y = [], []
    for f in (0, 1):
        judge = Judge(ordinary, _trained(now[1 - f], TOXIC_BYTES, TOXIC_SEGMENT), lengths)
        for label, texts in ((1, folds[f]), (0, others[f::2])):
            x += [judge.figures(t) for t in texts]
            y += [label] * len(texts)
    x, y = np.array(x), np.array(y)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    weight = np.where(y == 1, 1.0, len(plain) / max(1, (y == 0).sum()))
    w = _logistic((x - mean) / scale, y, weight)
    p = 1 / (1 + np.exp(-np.clip(np.column_stack([(x - mean) / scale, np.ones(len(x))]) @ w, -35, 35)))
    cut_at = _best_cut(p, y, weight)
    w[-1] += np.log(TOXIC / (1 - TOXIC)) - np.log(cut_at / (1 - cut_at))
    return {
        "ordinary": np.frombuffer(ordinary, np.uint8),
        "toxic": np.frombuffer(_trained(now[0] + now[1], TOXIC_BYTES, TOXIC_SEGMENT), np.uint8),
        "mean": mean, "scale": scale, "weights": w,
    }


def _blocks(batches):
    """(order, label, text) of training rows; of a long text evenly spread blocks."""
    for batch in batches:
        out = []
        for text in batch.column("text"):
            data = (text.as_py() or "").encode()
            if len(data) > BLOCKS * BLOCK:
                data = b"".join(data[i : i + BLOCK] for i in np.linspace(0, len(data) - BLOCK, BLOCKS).astype(int))
            out.append(data)
        yield pa.RecordBatch.from_arrays([batch.column("turn"), batch.column("label"), pa.array(out, pa.binary())], names=["turn", "label", "text"])


def _fit(batches):
    rows = []
    for batch in batches:
        rows += zip(*(batch.column(c).to_pylist() for c in ("turn", "label", "text")))
    model = fit(rows)
    file = io.BytesIO()
    np.savez_compressed(file, **(model or {}))
    yield pa.RecordBatch.from_arrays([pa.array([file.getvalue()], pa.binary())], names=["model"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS) -> bytes:
    """The model as bytes.  Runs jobs; the result has a bounded size."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg(F.min(label_col).cast("int").alias("label"))
    counts = known.agg(F.count_if(F.col("label") == 1).alias("t"), F.count_if(F.col("label") == 0).alias("o")).first()
    part = 1 << 30
    turn = F.pmod(F.xxhash64("key", F.lit(13)), F.lit(part))
    share = F.when(F.col("label") == 1, F.lit(min(1.0, toxic_rows / max(counts["t"], 1)))).otherwise(F.lit(min(1.0, ordinary_rows / max(counts["o"], 1))))
    sample = known.where(F.col("label").isin(0, 1)).withColumn("turn", turn).where(F.col("turn") < share * part)
    # about toxic_rows + ordinary_rows rows of three numbers: small by the bound on the sample
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(sample), "key")
    cut = rows.select("turn", "label", "text").mapInArrow(K.tidy(_blocks), "turn long, label int, text binary")
    return bytes(cut.repartition(1).mapInArrow(K.tidy(_fit), "model binary").first()["model"])


def _score(model: bytes, at: int):
    def run(batches):
        found = np.load(io.BytesIO(model))
        known = "weights" in found.files
        if known:
            judge = Judge(found["ordinary"].tobytes(), found["toxic"].tobytes())
            mean, scale, weights = (found[c] for c in ("mean", "scale", "weights"))
        for batch in K.chunks(K.with_texts(batches, at), "text"):
            if known:
                x = np.array([judge.figures((t.as_py() or "").encode()) for t in batch.column("text")])
                score = 1 / (1 + np.exp(-np.clip((x - mean) / scale @ weights[:-1] + weights[-1], -35, 35)))
            else:
                score = np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score)], names=["row", "score"])

    return run


def score(docs: DataFrame, model: bytes, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score``: the estimated chance that the text is toxic, ``TOXIC`` at the calibrated cut."""
    carried = [c for c in docs.columns if c != score_col or c == text_col]
    row = T.StructType([docs.schema[c] for c in carried])
    schema = T.StructType([T.StructField("row", row), T.StructField("score", T.DoubleType())])
    scored = docs.select(F.struct(*carried).alias("row")).mapInArrow(K.tidy(_score(model, carried.index(text_col))), schema)
    return scored.select(*[F.col("row")[c].alias(c) for c in carried if c != score_col], F.col("score").alias(score_col))


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are kept for evaluation: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query
def op13_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity score and class."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    found = score(docs, train(docs, labels))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
