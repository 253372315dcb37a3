"""Vectorised helpers over one Arrow batch of texts (used inside tasks).

A batch of texts is viewed as one byte array plus row offsets, so words,
rolling hashes and window minima are NumPy passes, not Python loops.
All hashes are functions of content only: they agree across tasks, runs and
machines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: white space of the contracts: \x20 and \x09-\x0D
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
MULT_A = U64(0x9E3779B97F4A7C15)  # odd multipliers of the polynomial hashes
MULT_B = U64(0xC2B2AE3D27D4EB4F)
#: bytes of text worked on at once; keeps the temporary arrays near the cache
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0xA0761D6478BD642F)
    x ^= x >> U64(32)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * MULT_A)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(mult: U64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """mult**i and mult**-i modulo 2**64 for i < n (cached, grown by doubling)."""
    key = int(mult)
    have = _POWERS.get(key)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = U64(pow(key, -1, 1 << 64))
        both = []
        for m in (mult, inverse):
            a = np.full(size, m, dtype=U64)
            a[0] = 1
            both.append(np.cumprod(a, dtype=U64))
        have = _POWERS[key] = (both[0], both[1])
    return have


def window_hash(values: np.ndarray, k: int, mult: U64 = MULT_A) -> np.ndarray:
    """Polynomial hash of every k consecutive values; position independent, mixed."""
    n = len(values)
    if n < k:
        return np.zeros(0, dtype=U64)
    up, down = _powers(mult, n + 1)
    p = np.zeros(n + 1, dtype=U64)
    np.cumsum(values * up[:n], out=p[1:])
    return mix((p[k:] - p[:-k]) * down[: n - k + 1])


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, mult: U64 = MULT_A) -> np.ndarray:
    """Polynomial hash of values[s:e] for each span."""
    up, down = _powers(mult, len(values) + 1)
    p = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[: len(values)], out=p[1:])
    return mix((p[ends] - p[starts]) * down[starts] + (ends - starts).astype(U64) * MULT_B)


def window_argmin(values: np.ndarray, w: int) -> np.ndarray:
    """For each window of w values the index of its smallest (the last one among ties).

    Values are compared by their upper 40 bits; the index sits in the lower 24, so
    ``values`` may hold at most 2**24 items (callers pass pieces).
    """
    n = len(values)
    if n < w:
        return np.zeros(0, dtype=np.int64)
    low = U64((1 << 24) - 1)
    m = (values & ~low) | (low - np.arange(n, dtype=U64))
    span = 1
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < w:
        m = np.minimum(m[: n - w + 1], m[w - span: w - span + n - w + 1])
    return (low - (m & low)).astype(np.int64)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and row offsets (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # an empty table has no chunk
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    big = pa.types.is_large_string(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if big else np.int32)
    offsets = offsets[column.offset: column.offset + len(column) + 1].astype(np.int64)
    base = offsets[0]
    size = int(offsets[-1] - base)
    raw = np.frombuffer(data, dtype=np.uint8, count=size, offset=int(base)) if size else np.zeros(0, np.uint8)
    return raw, offsets - base


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges (i, j) of at most ``limit`` bytes each; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray, is_space: np.ndarray = IS_SPACE):
    """Starts and ends (byte positions) of all words, and the first word of each row.

    ``offsets`` are row offsets into ``data``; words never cross rows.
    """
    n_rows = len(offsets) - 1
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n_rows + 1, np.int64)
    solid = ~is_space[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[at] = solid[at]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    at = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[at] = solid[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word's bytes."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    return span_hash(_BYTE_VALUE[data], starts, ends)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUE[data]


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    if len(x) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(x[1:] != x[:-1]) + 1
    return np.r_[0, cut], np.r_[cut, len(x)]
