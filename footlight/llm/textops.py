"""Vectorised text work inside Arrow tasks: words, word hashes and row slices of bounded size.

Words are the runs ``[^\\x20\\x09-\\x0D]+``.  Hashes are 64 bits wide and equal on every executor and in every run,
so they name words and word sequences globally without a shuffle.  All arithmetic wraps at 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Rows are handled in slices of about this many bytes of text; one longer row is a slice of its own.
SLICE_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 3)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column in a row, and where each begins (one more entry at the end); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8, at[-1] - at[0], at[0]), at - at[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices holding about ``limit`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends, first, total = np.cumsum(sizes), 0, 0
    while first < len(sizes):
        last = max(int(np.searchsorted(ends, total + limit, "right")), first + 1)
        yield batch.slice(first, last - first)
        first, total = last, int(ends[last - 1])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte positions where the words begin and end, and the row of each word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for base in (_BASE, inverse):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span, taken eight bytes at a time over all spans at once."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded.view(np.uint8)[:8].view(np.uint64), (len(data) + 1,), (1,))
    size = ends - starts
    acc = mix((eight[starts] & _MASKS[np.minimum(size, 8)]) + size.astype(np.uint64) * _BASE + np.uint64(seed))
    at, rest = 8, np.flatnonzero(size > 8)
    while len(rest):
        part = eight[starts[rest] + at] & _MASKS[np.minimum(size[rest] - at, 8)]
        acc[rest] = mix((acc[rest] * _BASE) ^ part)
        at += 8
        rest = rest[size[rest] > at]
    return acc


def hash_runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive symbols (``len(h) - k + 1`` of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for i in range(k):
        acc *= _BASE
        acc += h[i : n + i]
    return mix(acc)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List array of consecutive ``values``, ``counts`` of them per row."""
    at = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))


def rolling(h: np.ndarray, first: np.ndarray, k: int | np.ndarray) -> np.ndarray:
    """Hash of the ``k`` symbols that begin at each of ``first``, by prefix sums (``k`` may differ from place to place)."""
    power, inverse = _powers(1 << max(len(h).bit_length(), 16))
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * power[: len(h)], dtype=np.uint64, out=sums[1:])
    return mix((sums[first + k] - sums[first]) * inverse[first])
