"""Vectorised scans of UTF-8 text inside a task: words, hashes, k-grams, window minima.

Every function works on one slice of an Arrow string column: ``data`` (the bytes as a uint8
array) and ``bounds`` (the byte offset of each document, one more than documents). Python
loops run over slices, never over words. Hashes of ranges are polynomials modulo the prime
2**61 - 1 in a fixed random base, so two different ranges of n symbols agree for at most n of
2**61 bases, whatever their pattern; where more is at stake two bases are used side by side.
Hashes of k-grams (k small and fixed) are cheaper polynomials modulo 2**64. Both are finished
with an integer mixer; equal input always gives an equal hash.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # bytes of text handled at once; one longer document is a slice of its own

HASH_BLOCK = 1 << 14  # symbols

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240501))
_BYTE_TABLE = _RNG.integers(1, 1 << 30, 256, dtype=np.uint64) * U64(2) + U64(1)  # of 31 bits: their products are cheap
_BASE = int(_RNG.integers(1, 1 << 63, dtype=np.uint64)) * 2 + 1 & (1 << 64) - 1

PRIME = (1 << 61) - 1
_P, _LOW31, _LOW30 = U64(PRIME), U64((1 << 31) - 1), U64((1 << 30) - 1)
#: Bases of the two independent range hashes.
BASES = tuple(int(b) for b in _RNG.integers(1 << 60, PRIME, 2, dtype=np.uint64))

#: Byte classes: white space as the contracts define it, and the identity / A-Z lower-casing maps.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME."""
    x = (x & _P) + (x >> U64(61))
    return np.where(x >= _P, x - _P, x)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME but for a multiple of it, below 2**63 + 2**33. The halves' products stay
    below 2**64, and 2**61 is 1."""
    b1, b0 = b >> U64(31), b & _LOW31
    if a.size and a.max() <= _LOW31:
        middle = a * b1
        out = a * b0
    else:
        a1, a0 = a >> U64(31), a & _LOW31
        middle = a1 * b0
        middle += a0 * b1
        out = a0 * b0
        a1 *= b1
        a1 <<= U64(1)
        out += a1
    out += middle >> U64(30)
    middle &= _LOW30
    middle <<= U64(31)
    out += middle
    return out


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, both below it."""
    return reduced(_product(a, b))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo PRIME (kept and doubled as longer slices come)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.empty(size, dtype=np.uint64)
        out[0] = 1
        filled = 1
        while filled < size:
            step = min(filled, size - filled)
            out[filled:filled + step] = times(out[:step], U64(pow(base, filled, PRIME)))
            filled += step
        _powers[base] = have = out
    return have[:n]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """(batch slice, data, bounds): runs of whole rows with at most ``limit`` bytes of text, one
    row at least. Null texts are empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            continue
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
        start = 0
        while start < len(texts):
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), len(texts))
            yield batch.slice(start, stop - start), raw[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
            start = stop
    give_back()


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Words:
    """Word spans of a slice: byte ``starts`` / ``ends``, the document of each word, and ``first``
    (index of each document's first word; one more than documents)."""

    __slots__ = ("starts", "ends", "first", "doc")

    def __init__(self, data: np.ndarray, bounds: np.ndarray, breaks: np.ndarray = SPACE):
        inside = ~breaks[data]
        edge = np.empty(len(data) + 1, dtype=bool)  # a word may begin here
        edge[0] = edge[-1] = True
        edge[1:-1] = ~inside[:-1]
        edge[bounds] = True
        self.starts = np.flatnonzero(inside & edge[:-1])
        after = np.empty(len(data), dtype=bool)
        after[:-1] = ~inside[1:]
        if len(data):
            after[-1] = True
        after[bounds[(bounds > 0)] - 1] = True
        self.ends = np.flatnonzero(inside & after) + 1
        self.first = np.searchsorted(self.starts, bounds)
        self.doc = np.repeat(np.arange(len(bounds) - 1), np.diff(self.first))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = 0) -> np.ndarray:
    """Hash of values[starts[i]:ends[i]] (uint64 values), whatever the length of each range, in the
    first or second of BASES. Running sums of the terms' upper and lower halves can't overflow."""
    power = powers(BASES[base], len(values))
    high, low = (np.empty(len(values) + 1, dtype=np.uint64) for _ in range(2))
    high[0] = low[0] = 0
    for a in range(0, len(values), HASH_BLOCK):  # blocks that stay in the processor's cache
        part = values[a:a + HASH_BLOCK]
        terms = _product(part if part.max() <= _LOW31 else reduced(part), power[a:a + HASH_BLOCK])
        np.right_shift(terms, U64(31), out=high[a + 1:a + 1 + len(terms)])
        np.bitwise_and(terms, _LOW31, out=low[a + 1:a + 1 + len(terms)])
    np.cumsum(high, out=high)
    np.cumsum(low, out=low)
    high, low = high[ends] - high[starts], low[ends] - low[starts]
    total = reduced((high >> U64(30)) + ((high & _LOW30) << U64(31)) + reduced(low))
    shifted = times(total, powers(pow(BASES[base], -1, PRIME), len(values) + 1)[starts])
    return mix(shifted + (ends - starts).astype(np.uint64) * U64(0x9E3779B97F4A7C15))


def byte_values(data: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    return (_BYTE_TABLE if fold is None else _BYTE_TABLE[fold])[data]


def word_hashes(data: np.ndarray, words: Words, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of every word's bytes (after the byte map ``fold``)."""
    return range_hashes(byte_values(data, fold), words.starts, words.ends)


def kgrams(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive values; len(values) - k + 1 of them (none if shorter).
    Built by doubling: runs of 2, 4, 8 ... are combined to k."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    done, out, size, power = 0, None, 1, values
    while True:
        if k & size:
            part = power[done:done + n]
            out = part.copy() if out is None else out + part * U64(pow(_BASE, done, 1 << 64))
            done += size
        if done == k:
            return mix(out)
        m = len(power) - size
        power = power[:m] + power[size:size + m] * U64(pow(_BASE, size, 1 << 64))
        size *= 2


def leftmost_minima(values: np.ndarray, w: int) -> np.ndarray:
    """For every run of w consecutive values, the index of its smallest one (the first if tied)."""
    n = len(values) - w + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    at = np.arange(len(values), dtype=np.int32 if len(values) < 1 << 31 else np.int64)
    best = values
    size = 1
    while size < w:  # runs of 2, 4, 8 ...; the last step overlaps
        step = min(size, w - size)
        m = len(best) - step
        later = best[step:step + m] < best[:m]
        at = np.where(later, at[step:step + m], at[:m])
        best = np.minimum(best[:m], best[step:step + m])
        size += step
    return at[:n]


def char_starts(data: np.ndarray) -> np.ndarray:
    """True where a code point begins."""
    return (data & 0xC0) != 0x80


def text_marks(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A 64-bit mark of every document's bytes: tells rows with the same id and other texts apart."""
    return pa.array(range_hashes(byte_values(data), bounds[:-1], bounds[1:]).view(np.int64))
