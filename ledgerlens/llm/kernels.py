"""Numpy helpers for whole texts inside Arrow tasks: tokens, rolling names, ragged slices.

Everything here works on one bounded chunk of documents at a time (a few MB of
UTF-8 plus at least one document), so a task's memory does not follow its input.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc

import numpy as np
import pyarrow as pa

#: Text bytes handled together in one numpy pass.
CHUNK_BYTES = 1 << 20

#: Word separators: space and the ASCII controls 9-13.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])

_rng = np.random.Generator(np.random.PCG64(20240229))
#: A random odd 64-bit value for each byte, twice (two independent names of a string).
BYTE_NAMES = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) | np.uint64(1)
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.full(size, np.uint64(b)) for b in (self.base, self.inverse))
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        return self.up[:n], self.down[:n]


_POWERS = tuple(_Powers(b) for b in _ODD)


def slice_names(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit name of each ``values[start:end]`` that depends on its content alone.

    ``values``: uint64.  Polynomial names from prefix sums modulo 2**64, shifted to
    a common exponent, with the length mixed in.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _POWERS[which].get(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    names = (sums[ends] - sums[starts]) * down[starts]
    return mix(names + (ends - starts).astype(np.uint64) * np.uint64(_ODD[1 - which]))


def window_names(values: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """The name of every ``values[i:i+width]`` (fewer than ``width`` values: none)."""
    n = max(0, len(values) - width + 1)
    starts = np.arange(n)
    return slice_names(values, starts, starts + width, which)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another and the offsets of each (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches, column: str, limit: int = CHUNK_BYTES):
    """Cut Arrow batches into pieces of at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(text_buffer(batch.column(column))[1])
        total = np.cumsum(sizes)
        begin = 0
        while begin < len(sizes):
            base = total[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def release_memory() -> None:
    """Give freed memory back to the system: an idle worker would keep what its last task needed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A function of Arrow batches that gives its memory back when its partition ends."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


def with_texts(batches, at: int):
    """Batches of a struct column ``row`` with its field ``at`` as a column ``text`` (no copy)."""
    for batch in batches:
        yield batch.append_column("text", batch.column("row").field(at))


def byte_table(separators) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


_BLANK = byte_table(BLANKS)


def token_spans(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _BLANK):
    """Starts and ends (byte positions) of all tokens, and each text's first token number.

    A token is a maximal run of bytes outside ``separators`` within one text; the
    returned third array has one entry more than there are texts.
    """
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separators[buf]
    edge = np.ones(n + 1, bool)
    edge[1:n] = ~inside[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(inside & edge[:n])
    edge[1:n] = ~inside[1:]
    edge[offsets] = True
    ends = np.flatnonzero(inside & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte as it is."""
    return np.where((buf >= 0x41) & (buf <= 0x5A), buf | 0x20, buf)


def token_names(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    return slice_names(BYTE_NAMES[which][buf], starts, ends, which)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start, start+1, ...`` of each slice, one slice after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - first, lengths)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``values[i:i+width]``, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    now, size = values, 1
    while 2 * size <= width:
        now = np.minimum(now[:-size], now[size:])
        size *= 2
    return np.minimum(now[:n], now[width - size : width - size + n]) if size < width else now[:n]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    change = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys: True where a row's key differs from that of the row before."""
    n = len(keys[0])
    first = np.zeros(n, bool)
    if n:
        first[0] = True
        for k in keys:
            first[1:] |= k[1:] != k[:-1]
    return first
