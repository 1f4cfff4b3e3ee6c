"""Vectorised word scanning over Arrow string columns.

``scan`` finds and hashes all words of a whole record batch with numpy passes over the
UTF-8 bytes (no per-word Python).  Bytes >= 0x80 are always word bytes, so a multi-byte
character is never split.  Work memory is bounded by ``PIECE`` bytes at a time plus 24
bytes per word found; one text may be of any length.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from functools import wraps
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 18  # bytes hashed at a time
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_ROLL = np.uint64(0xD6E8FEB86659FD93)
_CACHE: dict = {}


class Words(NamedTuple):
    """Words of a batch: 64-bit hash, byte range in ``data``, and CSR offsets per row."""

    hash: np.ndarray   # uint64, one per word
    start: np.ndarray  # int64 byte offsets into data
    end: np.ndarray
    first: np.ndarray  # int64, len rows + 1: words of row i are first[i]:first[i + 1]
    data: np.ndarray   # uint8, lower-cased if asked for

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of an Arrow string column; NULL counts as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, off, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def whitespace_table() -> np.ndarray:
    """Words are runs of anything but space and the control characters 9-13."""
    word = np.ones(256, bool)
    word[[32, 9, 10, 11, 12, 13]] = False
    return word


def alnum_table() -> np.ndarray:
    """Words are runs of ASCII letters, digits and non-ASCII characters."""
    word = np.zeros(256, bool)
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        word[lo:hi] = True
    return word


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for n positions."""
    if _CACHE.get("n", 0) < n:
        n = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for key, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _CACHE[key] = np.cumprod(steps)
        _CACHE["values"] = mix(np.arange(1, 257, dtype=np.uint64) * _BASE) | np.uint64(1)
        _CACHE["n"] = n
    return _CACHE["up"], _CACHE["down"]


def _hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for ascending, non-overlapping ranges of one piece."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CACHE["values"][data] * up[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def scan(column, word: np.ndarray, lower: bool, zeros: bool = False) -> Words:
    """All words of a string column: ``word`` says which bytes belong to words.

    ``lower``: A-Z count as a-z; ``zeros``: every digit counts as 0.
    """
    data, offsets = utf8(column)
    if lower:
        data = lower_ascii(data)
    if zeros:
        table = np.arange(256, dtype=np.uint8)
        table[48:58] = 48
        data = table[data]
    hashes, starts, ends = [], [], []
    at, total = 0, len(data)
    bounds = np.unique(offsets)  # a word never runs across two rows
    while at < total:
        to = _cut(data, bounds, word, at, total)
        piece = data[at:to]
        inside = word[piece]
        cut = np.zeros(len(piece) + 1, bool)
        lo, hi = np.searchsorted(bounds, (at, to))
        cut[bounds[lo:hi] - at] = True
        cut[0] = cut[-1] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:] | cut[1:-1]
        start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        hashes.append(_hash_ranges(piece, start, end))
        starts.append(start + at)
        ends.append(end + at)
        at = to
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), start,
                 np.concatenate(ends) if ends else np.zeros(0, np.int64),
                 np.searchsorted(start, offsets).astype(np.int64), data)


def _cut(data, bounds, word, at: int, total: int) -> int:
    """End of the piece that begins at ``at``: a row boundary or a place beside a separator."""
    if total - at <= PIECE:
        return total
    to = at + PIECE
    apart = np.flatnonzero(~word[data[at:to]])
    row = bounds[np.searchsorted(bounds, to, side="right") - 1]
    best = max(int(row), at + int(apart[-1]) + 1 if len(apart) else at)
    while best <= at:  # one word longer than a piece
        row = bounds[np.searchsorted(bounds, to)]
        apart = np.flatnonzero(~word[data[to: min(to + PIECE, int(row))]])
        if len(apart):
            return to + int(apart[0])
        if row <= to + PIECE:
            return int(row)
        to += PIECE
    return best


def windows(words: Words, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words that stay inside one row, and the index of their first word."""
    h, n = words.hash, len(words.hash)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if salt:
        h = mix(h + np.uint64(salt))
    acc = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        acc *= _ROLL
        acc += h[j: n - k + 1 + j]
    left = np.repeat(words.first[1:], words.counts)[: n - k + 1]
    at = np.flatnonzero(np.arange(n - k + 1) + k <= left)
    return mix(acc[at]), at


def row_of(words: Words, at: np.ndarray) -> np.ndarray:
    """Row that holds each word index."""
    return np.searchsorted(words.first, at, side="right") - 1


def slices(batch: pa.RecordBatch, column: str, limit: int = 8 << 20):
    """Cut a record batch into runs of rows of about ``limit`` text bytes (one row at least)."""
    text = batch.column(column)
    sizes = np.diff(utf8(text)[1])
    at = 0
    while at < batch.num_rows:
        n = int(np.searchsorted(np.cumsum(sizes[at:]), limit, side="right"))
        n = max(1, n)
        yield batch.slice(at, n)
        at += n


def released(task: Callable) -> Callable:
    """The task function ``task``, whose worker gives freed memory back to the system when it ends.

    Spark keeps workers for later tasks; what their allocators hold meanwhile adds up beside the
    stages that follow.
    """
    @wraps(task)
    def run(batches):
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
            trim(0)
    return run
