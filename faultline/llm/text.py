"""Vectorised tokenising of Arrow string columns, shared by the operators.

Everything here runs inside a Spark task on one Arrow batch.  Texts are cut
into chunks of a few megabytes (a longer text is one chunk), so the numpy
temporaries stay bounded whatever the batch holds.  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18
SHINGLE = 5

_rng = np.random.default_rng(20240917)
BYTE_VALUE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INV = np.uint64(pow(int(BASE), -1, 2**64))
POSITION = _rng.integers(1, 2**64 - 1, SHINGLE, dtype=np.uint64) | np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i below n at least."""
    if len(_powers[0]) < n:
        size = 1 << max(19, int(n - 1).bit_length())
        for k, base in enumerate((BASE, BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, off.astype(np.int64)


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of about ``size`` bytes."""
    data, off = buffers(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true bytes; a run never crosses a text's end."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(BYTE_VALUE[data] * up[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def word_starts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (ASCII lower-cased, split at ASCII white space) and
    where each begins."""
    data = LOWER[data]
    start, end = spans(~SPACE[data], off)
    return span_hashes(data, start, end), start


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and the n + 1 offsets of each text's words."""
    w, start = word_starts(data, off)
    return w, np.searchsorted(start, off)


def run_hashes(items: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``items[start:end]`` of hashes, in order."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = powers(len(items) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(items * up[:len(items)], dtype=np.uint64)))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(w: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the k-word shingles of one text's word hashes, in order; with
    fewer words the whole sequence is one shingle, without words there is none."""
    if len(w) >= k:
        s = w[:len(w) - k + 1] * POSITION[0]
        for i in range(1, k):
            s = s + w[i:len(w) - k + 1 + i] * POSITION[i]
        return mix(s)
    if not len(w):
        return w
    return mix((w * POSITION[:len(w)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(w)))


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for i, j, data, off in chunks(column):
        w, word_off = words(data, off)
        for r in range(j - i):
            s = np.sort(shingles(w[word_off[r]:word_off[r + 1]]))
            yield s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s
