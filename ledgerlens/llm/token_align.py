"""Alignment of two tokenizers: products of token-byte incidence matrices in CSR form.

Every text is encoded by a byte-level BPE (A, given a space before the text) and by a
sentencepiece BPE (B, which adds that space).  A token covers bytes, so a tokenizer gives a
sparse matrix of tokens by bytes; the product A Bᵀ, row by row after Gustavson, holds for
every A token the B tokens whose bytes overlap it: the overlap links, valued by the bytes
shared.  Byte offsets where tokens of both end cut the text into groups; the product of the
token-group matrices holds the links of tokens that share a group (``n_group_links`` counts
them by the row sizes that the product's symbolic phase gives).

A text is encoded by segments.  It is cut before every single space that follows and
precedes other characters: neither tokenizer has a token across such a place (A splits
there before it merges, no piece of B holds a space after another character; see
``cuts``), so the tokens are those of the whole text, and tokens of both end there, so
no link or group crosses it.  A segment met again in the same task costs a lookup.

Counts of id pairs over the corpus: a task turns about ``CHUNK_BYTES`` of text into one
list of distinct id pairs with their links, and each text's links into places in that
list.  The lists are summed by pair (one row per pair and chunk), every pair is compared
with the most frequent one of its B id, and the figures go back to the chunk's list; a
text's own links never leave their chunk.  A frequent pair has one row per chunk, and
joins have one row per pair on one side, so Spark can split it.

Definitions: texts that are null or empty, and texts whose tokens do not spell the space
and the text byte by byte, have no tokens (zeros, ''); of very long texts a task
holds the bytes, the distinct segments and the distinct id pairs, and hashes groups as they
come (a text without any cut is one segment and is held by the tokenizers whole); ties for a B
id's highest count are all best; repeated rows are aligned each, also those without id;
columns other than the id and the text are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm import kernels as K, query
from ledgerlens.llm.tables import stored

#: Files of the two tokenizers: the folder is a parameter.
TOKENIZERS, BYTE_BPE, PIECE_BPE = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Text bytes of a chunk, whose id pairs are counted together.
CHUNK_BYTES = 8 << 20
#: Segments that a task remembers, and nonzeros of a product that it expands at a time.
REMEMBERED, EXPANDED = 400_000, 1 << 20


# ---------------------------------------------------------------------------
# Sparse matrices
# ---------------------------------------------------------------------------


@dataclass
class Csr:
    """A sparse matrix by rows: row i has ``columns`` and ``values`` from ``indptr[i]`` to ``indptr[i+1]``."""

    indptr: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def transposed(self) -> "Csr":
        order = np.argsort(self.columns, kind="stable")
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(indptr, np.repeat(np.arange(self.rows), np.diff(self.indptr))[order], self.values[order], self.rows)


def incidence(ends: np.ndarray, bytes_: int) -> Csr:
    """Tokens by bytes: token i covers the bytes from the end of the one before to its own end."""
    return Csr(np.concatenate([[0], ends]), np.arange(bytes_), np.ones(bytes_, np.int64), bytes_)


def row_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Symbolic phase: how many products each row of ``a b`` sums up."""
    sizes = np.concatenate([[0], np.cumsum(np.diff(b.indptr)[a.columns])])
    return sizes[a.indptr[1:]] - sizes[a.indptr[:-1]]


def product(a: Csr, b: Csr) -> Csr:
    """``a b`` by rows: the rows of ``b`` that a row of ``a`` names, scaled and summed up.

    Rows are taken together as long as they expand to ``EXPANDED`` products (or one row).
    """
    upto = np.cumsum(row_sizes(a, b))
    counts, columns, values, begin = [], [], [], 0
    while begin < a.rows:
        base = upto[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(upto, base + EXPANDED, side="right")))
        at = slice(a.indptr[begin], a.indptr[stop])
        named = a.columns[at]
        lengths = np.diff(b.indptr)[named]
        reach = K.ragged(b.indptr[:-1][named], lengths)
        row = np.repeat(np.repeat(np.arange(stop - begin), np.diff(a.indptr[begin : stop + 1])), lengths)
        value = np.repeat(a.values[at], lengths) * b.values[reach]
        key = row * b.width + b.columns[reach]
        order = np.argsort(key, kind="stable")
        fresh = np.flatnonzero(K.group_starts(key[order]))
        key = key[order][fresh]
        counts.append(np.bincount(key // b.width, minlength=stop - begin))
        columns.append(key % b.width)
        values.append(np.add.reduceat(value[order], fresh) if len(fresh) else value)
        begin = stop
    none = [np.zeros(0, np.int64)]
    return Csr(np.concatenate([[0], np.cumsum(np.concatenate(counts or none))]), np.concatenate(columns or none), np.concatenate(values or none), b.width)


# ---------------------------------------------------------------------------
# Tokenizers
# ---------------------------------------------------------------------------


def _byte_alphabet() -> dict[str, int]:
    """Characters of a byte-level vocabulary: visible Latin-1 ones stand for themselves, the rest from 256 on."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A with the bytes of each of its ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet = _byte_alphabet()
        self.bytes = {i: bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
                      for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}

    def ids(self, segments: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]


class Pieces:
    """Tokenizer B with the bytes of each of its ids."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        self.bytes = {}
        for i in range(self.processor.get_piece_size()):
            piece = self.processor.id_to_piece(i)
            self.bytes[i] = bytes([int(piece[3:-1], 16)]) if self.processor.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, segments: list[str]) -> list[list[int]]:
        """Of segments that begin with a space, which the tokenizer adds itself."""
        return self.processor.encode([s[1:] for s in segments], num_threads=1)


_LOADED: dict[str, tuple] = {}


def tokenizers(folder: str) -> tuple[ByteLevel, Pieces]:
    """Both tokenizers, loaded once per process."""
    if folder not in _LOADED:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _LOADED[folder] = ByteLevel(f"{folder}/{BYTE_BPE}"), Pieces(f"{folder}/{PIECE_BPE}")
    return _LOADED[folder]


_VISIBLE = K.byte_table(range(0x21, 0x7F))
#: First bytes of UTF-8 characters that may be white space, and bytes inside a character.
_MAYBE_BLANK = K.byte_table([*range(0x80, 0xC0), 0xC2, 0xE1, 0xE2, 0xE3])


def cuts(buf: np.ndarray) -> np.ndarray:
    """Places of single spaces before which a text may be cut without changing its tokens.

    A's pattern never has white space after another character in one piece, and of several
    blanks before a character gives the last to it; so a cut is safe where a visible ASCII
    character precedes, or something that is surely not white space follows.  No piece of B
    holds a space after another character, so no merge crosses a single space's front.
    """
    if len(buf) < 3:
        return np.zeros(0, np.int64)
    before, here, after = buf[:-2], buf[1:-1], buf[2:]
    single = (here == 0x20) & (before != 0x20) & (after != 0x20)
    sure = _VISIBLE[before] | _VISIBLE[after] | ((after >= 0x80) & ~_MAYBE_BLANK[after])
    return np.flatnonzero(single & sure) + 1


# ---------------------------------------------------------------------------
# Segments and texts
# ---------------------------------------------------------------------------


class Segments:
    """Aligned segments, numbered; all arrays are ragged over the segments' numbers."""

    def __init__(self, folder: str):
        self.tokenizers = tokenizers(folder)
        # by id: the bytes, their number, and the id as text
        self.spelt = [[t.bytes.get(i, b"") for i in range(max(t.bytes) + 2)] for t in self.tokenizers]
        self.lengths = [np.array(list(map(len, known))) for known in self.spelt]
        self.names = list(map(str, range(max(map(len, self.spelt)))))
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 6), np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)

    def learn(self, fresh: list[bytes]) -> None:
        """Align segments that have not been met: their tokens, links and groups."""
        texts = [s.decode() for s in fresh]
        ids = [t.ids(texts) for t in self.tokenizers]
        every = [list(chain.from_iterable(own)) for own in ids]
        good = np.ones(len(fresh), bool)
        for own, all_, spelt in zip(ids, every, self.spelt):
            if b"".join(map(spelt.__getitem__, all_)) != b"".join(fresh):
                good &= [b"".join(map(spelt.__getitem__, found)) == s for found, s in zip(own, fresh)]
        at = np.flatnonzero(good)
        length = np.array(list(map(len, fresh)))[at]
        total = int(length.sum())
        flat, ends, owner = [], [], []
        for k, (own, size) in enumerate(zip(ids, self.lengths)):
            if len(at) < len(fresh):
                own = [own[i] for i in at]
                every[k] = list(chain.from_iterable(own))
            flat.append(np.array(every[k], np.int64))
            ends.append(np.cumsum(size[flat[-1]]))
            owner.append(np.repeat(at, np.array(list(map(len, own)), np.int64)))
        a, b = (incidence(e, total) for e in ends)
        links = product(a, b.transposed())
        per_a = np.diff(links.indptr)
        both = np.intersect1d(ends[0], ends[1], assume_unique=True)
        in_group = groups_of(ends, both)
        segments = len(fresh)
        sizes = np.stack([
            np.bincount(owner[0], minlength=segments),
            np.bincount(owner[1], minlength=segments),
            np.bincount(np.repeat(at, length)[both - 1], minlength=segments),
            np.bincount(owner[0], per_a, segments),
            np.bincount(owner[0], row_sizes(in_group[0], in_group[1].transposed()), segments),
            good,
        ], 1).astype(np.int64)
        self.pairs = np.concatenate([self.pairs, (np.repeat(flat[0], per_a) << 32) | flat[1][links.columns]])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes[:, 3])])
        self.sizes = np.concatenate([self.sizes, sizes])
        sides = []
        for all_, where in zip(every, in_group):
            text, cut = list(map(self.names.__getitem__, all_)), np.searchsorted(where.columns, np.arange(len(both) + 1)).tolist()
            sides.append([",".join(text[x:y]) for x, y in zip(cut, cut[1:])])
        named = [f"{x}|{y}" for x, y in zip(*sides)]
        cut = np.concatenate([[0], np.cumsum(sizes[:, 2])]).tolist()
        self.number.update(zip(fresh, range(len(self.groups), len(self.groups) + segments)))
        self.groups += [";".join(named[x:y]) for x, y in zip(cut, cut[1:])]

    def of(self, texts: list[bytes]) -> list[np.ndarray]:
        """The numbers of each text's segments, in order; segments not met before are aligned."""
        found = []
        for data in texts:
            whole = b" " + data
            at = [0, *cuts(np.frombuffer(whole, np.uint8)).tolist(), len(whole)] if data else [0]
            found.append([whole[x:y] for x, y in zip(at, at[1:])])
        known = self.number
        fresh = [s for s in dict.fromkeys(chain.from_iterable(found)) if s not in known]
        if fresh:
            self.learn(fresh)
        return [np.array(list(map(known.__getitem__, one)), np.int64) for one in found]


def groups_of(ends: list[np.ndarray], both: np.ndarray) -> list[Csr]:
    """Tokens by groups, for both sides: a token's group is the first that ends at or after its end."""
    return [Csr(np.arange(len(e) + 1), np.searchsorted(both, e), np.ones(len(e), np.int64), len(both)) for e in ends]


def align(texts: list[bytes], segments: Segments) -> list[dict]:
    """Each text's figures and its distinct id pairs (``a << 32 | b``) with their links; no tokens: zeros."""
    if len(segments.groups) > REMEMBERED:
        segments.forget()
    numbers = segments.of(texts)
    ok = [len(n) > 0 and bool(segments.sizes[n, 5].all()) for n in numbers]
    numbers = [n if fine else n[:0] for n, fine in zip(numbers, ok)]
    many = len(segments.groups) + 1
    owner = np.repeat(np.arange(len(texts)), [len(n) for n in numbers])
    key, times = np.unique(owner * many + np.concatenate([*numbers, np.zeros(0, np.int64)]), return_counts=True)
    owner, distinct = key // many, key % many
    sizes = segments.sizes[distinct]
    figures = np.zeros((len(texts), 5), np.int64)
    np.add.at(figures, owner, times[:, None] * sizes[:, :5])
    pairs, at = np.unique(segments.pairs[K.ragged(segments.starts[distinct], sizes[:, 3])], return_inverse=True)
    many = len(pairs) + 1
    key, back = np.unique(np.repeat(owner, sizes[:, 3]) * many + at, return_inverse=True)
    links = np.bincount(back, np.repeat(times, sizes[:, 3]), len(key)).astype(np.int64)
    cut = np.searchsorted(key // many, np.arange(len(texts) + 1))
    out = []
    for i, (own, fine) in enumerate(zip(numbers, ok)):
        mine = slice(cut[i], cut[i + 1])
        sha = hashlib.sha256() if fine else None
        for begin in range(0, len(own), 10000):
            sha.update((";" if begin else "").encode() + ";".join(map(segments.groups.__getitem__, own[begin : begin + 10000].tolist())).encode())
        out.append({"n": figures[i].tolist(), "sha": sha.hexdigest() if fine else "", "pairs": pairs[key[mine] % many], "links": links[mine]})
    return out


_FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]
_TEXT_SCHEMA = "chunk string, doc_id long, " + ", ".join(f"{c} long" for c in _FIGURES) + ", groups_sha256 string, places binary, links binary, pairs array<long>, counts array<long>"


def _aligned(folder: str):
    """Rows of texts; the last one of a chunk carries the chunk's pairs and their links."""

    def run(batches):
        from pyspark import TaskContext

        segments = Segments(folder)
        task, chunk = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def out():
            every = np.concatenate([h["pairs"] for _, h in held])
            pairs, at = np.unique(every, return_inverse=True)
            counts = np.bincount(at, np.concatenate([h["links"] for _, h in held]), len(pairs)).astype(np.int64)
            cut = np.cumsum([len(h["pairs"]) for _, h in held])[:-1]
            last = len(held) - 1
            columns = [
                pa.array([f"{task}-{chunk}"] * len(held)),
                pa.array([i for i, _ in held], pa.int64()),
                *[pa.array([h["n"][k] for _, h in held], pa.int64()) for k in range(len(_FIGURES))],
                pa.array([h["sha"] for _, h in held]),
                pa.array([p.astype(np.int32).tobytes() for p in np.split(at, cut)], pa.binary()),
                pa.array([h["links"].astype(np.int32).tobytes() for _, h in held], pa.binary()),
                pa.array([None] * last + [pairs.tolist()], pa.list_(pa.int64())),
                pa.array([None] * last + [counts.tolist()], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _TEXT_SCHEMA.split(", ")])

        for batch in K.chunks(batches, "text"):
            texts = [(t.as_py() or "").encode() for t in batch.column("text")]
            held += zip(batch.column("doc_id").to_pylist(), align(texts, segments))
            size += sum(map(len, texts)) + 1000 * len(texts)
            if size >= CHUNK_BYTES:
                yield out()
                held, size, chunk = [], 0, chunk + 1
        if held:
            yield out()

    return run


def _summed(key, texts: pa.Table, known: pa.Table) -> pa.Table:
    """One chunk: every text's links that are best, and the sum of its links' counts."""
    place = known.column("place").to_numpy()
    count, best = (np.zeros(len(place), np.int64) for _ in range(2))
    count[place], best[place] = known.column("count").to_numpy(), known.column("best").to_numpy()
    n_best, sums = [], []
    for places, links in zip(texts.column("places").to_pylist(), texts.column("links").to_pylist()):
        at, links = np.frombuffer(places, np.int32), np.frombuffer(links, np.int32).astype(np.int64)
        n_best.append(int(links @ best[at]))
        sums.append(int(links @ count[at]))
    out = texts.select(["doc_id", *_FIGURES, "groups_sha256"])
    return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


def align_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS) -> tuple[DataFrame, DataFrame]:
    """(texts, pairs): figures of every text, and (a_id, b_id, count, best) over the whole corpus.

    The texts' alignment runs when this is called and is stored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(K.tidy(_aligned(folder)), _TEXT_SCHEMA)
    texts = stored(texts, "aligned")
    lists = texts.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "found"))
    rows = lists.select("chunk", F.col("place").cast("long").alias("place"), F.col("found.pairs").alias("pair"), F.col("found.counts").alias("links"))
    counts = rows.groupBy("pair").agg(F.sum("links").alias("count")).withColumn("b_id", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    counts = stored(counts, "pairs")
    highest = counts.groupBy("b_id").agg(F.max("count").alias("highest"))
    marked = counts.join(highest, "b_id").select("pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))
    back = rows.join(marked, "pair").select(F.col("chunk").alias("of"), "place", "count", "best")
    own = texts.select("chunk", "doc_id", *_FIGURES, "groups_sha256", "places", "links")
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _FIGURES) + ", groups_sha256 string, n_best long, count_sum long"
    summed = own.groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(_summed, schema)
    pairs = marked.select(F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b_id"), "count", (F.col("best") == 1).alias("best"))
    return summed, pairs


def _link_rows(folder: str, kind: str):
    def run(batches):
        a_side, b_side = tokenizers(folder)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                data = (text.as_py() or "").encode()
                whole = b" " + data
                ids = [t.ids([whole.decode()])[0] if data else [] for t in (a_side, b_side)]
                spelt = [[t.bytes.get(i, b"") for i in found] for t, found in zip((a_side, b_side), ids)]
                if not data or any(b"".join(s) != whole for s in spelt):
                    continue
                ends = [np.cumsum([len(x) for x in s]) for s in spelt]
                if kind == "overlap":
                    found = product(incidence(ends[0], len(whole)), incidence(ends[1], len(whole)).transposed())
                else:
                    a, b = groups_of(ends, np.intersect1d(*ends))
                    found = product(a, b.transposed())
                row = np.repeat(np.arange(found.rows), np.diff(found.indptr))
                for begin in range(0, len(row), EXPANDED):
                    at = slice(begin, begin + EXPANDED)
                    a_id, b_id = (np.array(i, np.int64)[p[at]] for i, p in zip(ids, (row, found.columns)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id] * len(a_id), pa.int64()), *map(pa.array, (row[at], found.columns[at], a_id, b_id, found.values[at]))],
                        names=["doc_id", "a_pos", "b_pos", "a_id", "b_id", "shared"],
                    )

    return run


def token_links(docs: DataFrame, kind: str = "overlap", id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """Links of token occurrences, one row each: (doc_id, a_pos, b_pos, a_id, b_id, shared).

    ``kind``: ``overlap`` (tokens that share bytes; ``shared`` counts them) or ``group``
    (tokens of one group; ``shared`` is 1).
    """
    if kind not in ("overlap", "group"):
        raise ValueError(f"unknown kind of links {kind!r}")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(K.tidy(_link_rows(folder, kind)), "doc_id long, a_pos long, b_pos long, a_id long, b_id long, shared long")


@query
def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Every document's alignment of the two tokenizers."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return align_tokens(docs)[0]
