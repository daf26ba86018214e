"""A wavelet matrix over token ids, and the compressed file a shard of them is written to.

LEVELS bit planes, one for each bit of an id from the highest down. On every plane the ids stand in
a stable order: those with a 0 on the plane above come before those with a 1. So a plane's
``rank`` maps a place to its place on the next one, and ``select`` maps it back:

* ``access(i)`` reads one bit a plane on the way down;
* ``rank(token, i)`` / ``count(token)`` follow a token's bits down with both ends of a range;
* ``select(token, k)`` / ``occurrences(token)`` climb back from the lowest plane.

File, all numbers little-endian: MAGIC, a header (HEADER), the compressed table of documents (id,
whether it is null, number of ids), and for every plane its number of zeros, its rank directory
(ones before each block), the offsets of its blocks, and the blocks of BLOCK_BITS bits, each
compressed by itself. A look-up decompresses only the blocks it meets.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

MAGIC = b"KWM1"
LEVELS = 16
BLOCK_BITS = 1 << 15
_BLOCK_BYTES = BLOCK_BITS // 8
HEADER = np.dtype([("n", "<i8"), ("docs", "<i8"), ("table", "<i8"), ("table_packed", "<i8"), ("planes", "<i8", LEVELS)])
PLANE = np.dtype([("zeros", "<i8"), ("blocks", "<i8")])
DOCUMENT = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<i8")])


def _packed(raw: bytes) -> bytes:
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(raw, size: int) -> bytes:
    return pa.decompress(raw, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _columns(documents: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(documents[f]).tobytes() for f in DOCUMENT.names)


def encode(tokens: np.ndarray, documents: np.ndarray) -> bytes:
    """The file of a shard: ``tokens`` (uint16) of its DOCUMENT rows, one after the other."""
    n = len(tokens)
    table = _columns(documents)
    table_packed = _packed(table)
    header = np.zeros((), HEADER)
    header["n"], header["docs"], header["table"], header["table_packed"] = n, len(documents), len(table), len(table_packed)
    parts = [table_packed]
    at = len(MAGIC) + HEADER.itemsize + len(table_packed)
    order = tokens
    blocks = -(-n // BLOCK_BITS)
    for level in range(LEVELS):
        bit = (order & np.uint16(1 << LEVELS - 1 - level)) != 0
        raw = np.zeros(blocks * _BLOCK_BYTES, dtype=np.uint8)
        raw[:-(-n // 8)] = np.packbits(bit, bitorder="little")
        ones = np.bitwise_count(raw).reshape(blocks, _BLOCK_BYTES).sum(axis=1, dtype=np.int64)
        packed = [_packed(raw[i * _BLOCK_BYTES:(i + 1) * _BLOCK_BYTES].tobytes()) for i in range(blocks)]
        plane = np.zeros((), PLANE)
        plane["zeros"], plane["blocks"] = n - ones.sum(), blocks
        rank = np.append(0, np.cumsum(ones)).astype("<i8")
        offset = np.append(0, np.cumsum([len(p) for p in packed])).astype("<i8")
        header["planes"][level] = at
        section = b"".join([plane.tobytes(), rank.tobytes(), offset.tobytes(), *packed])
        parts.append(section)
        at += len(section)
        order = np.concatenate([np.compress(~bit, order), np.compress(bit, order)])
    return b"".join([MAGIC, header.tobytes(), *parts])


class _Plane:
    """One bit plane of a file; blocks are decompressed when they are met."""

    def __init__(self, file: memoryview, at: int, n: int):
        plane = np.frombuffer(file, PLANE, 1, at)[0]
        self.n, self.zeros, blocks = n, int(plane["zeros"]), int(plane["blocks"])
        at += PLANE.itemsize
        self.before = np.frombuffer(file, "<i8", blocks + 1, at)
        at += 8 * (blocks + 1)
        self.offset = np.frombuffer(file, "<i8", blocks + 1, at)
        self.file, self.start = file, at + 8 * (blocks + 1)
        self.block = lru_cache(maxsize=4)(self._block)

    def _block(self, i: int) -> np.ndarray:
        raw = self.file[self.start + int(self.offset[i]):self.start + int(self.offset[i + 1])]
        return np.frombuffer(_unpacked(raw, _BLOCK_BYTES), np.uint8)

    def bits(self) -> np.ndarray:
        raw = [self._block(i) for i in range(len(self.before) - 1)]
        return np.unpackbits(np.concatenate(raw), bitorder="little")[:self.n].view(bool) if raw else np.empty(0, bool)

    def bit(self, i: int) -> int:
        return int(self.block(i // BLOCK_BITS)[i % BLOCK_BITS // 8]) >> i % 8 & 1

    def ones(self, i: int) -> int:
        """Ones before place i."""
        block, inside = divmod(i, BLOCK_BITS)
        if not inside:
            return int(self.before[block])
        raw = self.block(block)
        whole = int(np.bitwise_count(raw[:inside // 8]).sum(dtype=np.int64))
        return int(self.before[block]) + whole + (int(raw[inside // 8]) & (1 << inside % 8) - 1).bit_count()

    def place(self, bit: int, k: int) -> int:
        """Place of the k-th (from 0) one, or zero."""
        before = self.before if bit else np.arange(len(self.before), dtype=np.int64) * BLOCK_BITS - self.before
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.block(block), bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - int(before[block])])


class Shard:
    """Reader of one file."""

    def __init__(self, file: bytes):
        view = memoryview(file)
        if bytes(view[:len(MAGIC)]) != MAGIC:
            raise ValueError("not a token shard")
        header = np.frombuffer(view, HEADER, 1, len(MAGIC))[0]
        self.n, docs = int(header["n"]), int(header["docs"])
        at = len(MAGIC) + HEADER.itemsize
        raw = _unpacked(view[at:at + int(header["table_packed"])], int(header["table"]))
        self.documents = np.zeros(docs, DOCUMENT)
        offset = 0
        for field in DOCUMENT.names:
            self.documents[field] = np.frombuffer(raw, DOCUMENT[field], docs, offset)
            offset += DOCUMENT[field].itemsize * docs
        self.starts = np.append(0, np.cumsum(self.documents["n"]))
        self.planes = [_Plane(view, int(at), self.n) for at in header["planes"]]

    def tokens(self) -> np.ndarray:
        """All ids: the stable order of each plane is undone, from the lowest up."""
        out = np.zeros(self.n, dtype=np.uint16)
        for level in reversed(range(LEVELS)):
            plane = self.planes[level]
            bit = plane.bits()
            above = np.empty_like(out)
            above[np.flatnonzero(~bit)] = out[:plane.zeros]
            above[np.flatnonzero(bit)] = out[plane.zeros:] | np.uint16(1 << LEVELS - 1 - level)
            out = above
        return out

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for plane in self.planes:
            bit, ones = plane.bit(i), plane.ones(i)
            token = token << 1 | bit
            i = plane.zeros + ones if bit else i - ones
        return token

    def _range(self, token: int, upto: int) -> tuple[int, int]:
        """Where the token's occurrences before place ``upto`` end up below the lowest plane."""
        low, high = 0, upto
        if not 0 <= token < 1 << LEVELS:
            return 0, 0
        for level, plane in enumerate(self.planes):
            if low == high:
                break
            a, b = plane.ones(low), plane.ones(high)
            low, high = (plane.zeros + a, plane.zeros + b) if token >> LEVELS - 1 - level & 1 else (low - a, high - b)
        return low, high

    def rank(self, token: int, i: int) -> int:
        """Occurrences of the token before place i."""
        low, high = self._range(token, min(max(i, 0), self.n))
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of the token's k-th occurrence, from 0."""
        low, high = self._range(token, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        at = low + k
        for level in reversed(range(LEVELS)):
            plane = self.planes[level]
            bit = token >> LEVELS - 1 - level & 1
            at = plane.place(bit, at - plane.zeros if bit else at)
        return at

    def occurrences(self, token: int) -> np.ndarray:
        """All places of the token, ascending: its stretch below the lowest plane climbs back as a whole."""
        low, high = self._range(token, self.n)
        at = np.arange(low, high, dtype=np.int64)
        for level in reversed(range(LEVELS)):
            if not len(at):
                break
            plane = self.planes[level]
            bit = bool(token >> LEVELS - 1 - level & 1)
            at = np.flatnonzero(plane.bits() == bit)[at - plane.zeros if bit else at]
        return at

    def document_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1
