"""Packing along a space-filling curve.

Every document is tokenised once. Its pieces are hashed into a vector of DIMENSIONS counts, scaled
to unit length, projected by a fixed random matrix to AXES coordinates, and placed on a Hilbert
curve: documents close on the curve use like words. The curve is cut into ranges by quantiles of
the key (a hash of the id below the Hilbert index breaks up groups of equal documents). The
ranges' token totals, one row per range, give each range its place in one long row of tokens,
so every task can cut its documents into sequences by itself: sequences run across documents and
ranges, and only the very last one is not full.

Tokenising: texts of ASCII and Latin-1 letters without apostrophes and special-token strings are
cut into the tokenizer's pieces by array operations, and only pieces not met before are encoded;
all other texts go to the tokenizer as a whole, and so does one with a piece whose bytes differ
from those remembered under its hash. All give the tokenizer's own ids.

Defined results: null text is empty and packs as the end token alone; rows are packed one by one,
so repeated and null ids each keep their pieces; an empty table gives an empty result; other
columns are ignored; a text of any length is cut like any other.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kestrel.llm import textscan as ts
from kestrel.llm.common import partitions, stored

TOKENIZER = "word_bpe_49k.json"
SEQUENCE = 2048
END = 1
DIMENSIONS, AXES, AXIS_BITS = 512, 4, 10
CACHE_PIECES = 1 << 20  # a Python worker forgets its pieces beyond that many

ENCODED = "id bigint, curve bigint, n bigint, ids binary"
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")

_PROJECTION = np.random.Generator(np.random.PCG64(3)).standard_normal((DIMENSIONS, AXES))

_OTHER, _SPACE, _LETTER, _DIGIT, _SIGN = range(5)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE


def tokenizer_at(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    if not os.path.isabs(path):
        import public_tokenizers
        path = public_tokenizers.path(path)
    return Tokenizer.from_file(str(path))


class Encoder:
    """ids of many texts at once, with the tokenizer's pieces remembered."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer_at(path)
        ends = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            ends[i] = token.endswith("</w>")
        self.ends = ends  # every piece ends with such a token, and no other token of it does
        self.forget()

    def forget(self):
        self.known, self.place, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint16)
        self.raw, self.raw_at, self.raw_size = np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)

    def learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        joined = [" ".join(pieces[i:i + 500]) for i in range(0, len(pieces), 500)]
        ids = np.concatenate([np.array(e.ids, dtype=np.uint16) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        last = np.flatnonzero(self.ends[ids])
        assert len(last) == len(pieces), "a piece was not encoded as one"
        size = np.diff(np.append(-1, last))
        known = np.concatenate([self.known, hashes])
        place = np.concatenate([self.place, len(self.pool) + last + 1 - size])
        size = np.concatenate([self.size, size])
        raw = [piece.encode() for piece in pieces]
        own_size = np.array([len(piece) for piece in raw], dtype=np.int64)
        raw_at = np.concatenate([self.raw_at, len(self.raw) + np.cumsum(own_size) - own_size])
        raw_size = np.concatenate([self.raw_size, own_size])
        order = np.argsort(known, kind="stable")
        self.known, self.place, self.size = known[order], place[order], size[order]
        self.raw_at, self.raw_size = raw_at[order], raw_size[order]
        self.pool = np.concatenate([self.pool, ids])
        self.raw = np.concatenate([self.raw, np.frombuffer(b"".join(raw), np.uint8)])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, hashes)
        at[at == len(self.known)] = 0
        return np.where(self.known[at] == hashes if len(self.known) else False, at, -1)

    def other_bytes(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Pieces that are not, byte by byte, those remembered under their hashes."""
        length = ends - starts
        wrong = length != self.raw_size[at]
        inside = np.arange(length.sum(), dtype=np.int64) - np.repeat(np.cumsum(length) - length, length)
        differ = low[np.repeat(starts, length) + inside] != self.raw[np.minimum(np.repeat(self.raw_at[at], length) + inside, max(len(self.raw) - 1, 0))]
        if differ.any():
            wrong[np.repeat(np.arange(len(starts)), length)[differ]] = True
        return np.flatnonzero(wrong)

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all documents, their bounds, vectors)."""
        n_docs = len(bounds) - 1
        plain = plain_documents(data, bounds)
        low, kind = lowered(data)
        starts, ends = pieces_of(kind, bounds)
        doc = np.searchsorted(bounds, starts, side="right") - 1
        use = plain[doc]
        starts, ends, doc = starts[use], ends[use], doc[use]
        hashes = ts.range_hashes(ts.byte_values(low), starts, ends)
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_PIECES:
            self.forget()
        new = np.flatnonzero(self.find(unique) < 0)
        if len(new):
            flat = low.tobytes()
            self.learn(unique[new], [flat[starts[i]:ends[i]].decode() for i in first[new]])
        at = self.find(unique)[back]
        odd = self.other_bytes(low, starts, ends, at)
        if len(odd):  # never seen with real words: a hash met with other bytes
            plain[doc[odd]] = False
            use = plain[doc]
            hashes, doc, at = hashes[use], doc[use], at[use]
        place, size = self.place[at], self.size[at]
        total = np.bincount(doc, weights=size, minlength=n_docs).astype(np.int64)

        vectors = np.bincount(doc * DIMENSIONS + (hashes % np.uint64(DIMENSIONS)).astype(np.int64), minlength=n_docs * DIMENSIONS).reshape(n_docs, DIMENSIONS).astype(np.float64)
        whole: dict[int, np.ndarray] = {}
        for d in np.flatnonzero(~plain):
            text = data[bounds[d]:bounds[d + 1]].tobytes().decode("utf-8", "replace")
            whole[d] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint16)
            total[d] = len(whole[d])
            vectors[d] = np.bincount((ts.mix(whole[d].astype(np.uint64)) % np.uint64(DIMENSIONS)).astype(np.int64), minlength=DIMENSIONS)

        edges = np.append(0, np.cumsum(total + 1))  # one more for the end token
        out = np.full(edges[-1], END, dtype=np.uint16)
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        source = np.repeat(place, size) + inside
        of_doc = np.append(0, np.cumsum(np.bincount(doc, weights=size, minlength=n_docs).astype(np.int64)))
        target = np.arange(len(source)) - np.repeat(of_doc[:-1], np.diff(of_doc)) + np.repeat(edges[:-1], np.diff(of_doc))
        out[target] = self.pool[source]
        for d, ids in whole.items():
            out[edges[d]:edges[d] + len(ids)] = ids
        return out, edges, vectors


def plain_documents(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Documents that array operations may cut: only ASCII without control characters and
    apostrophes and the letters and signs U+00C0 to U+00FF, and no `<|` of a special token."""
    bad = (_CLASS[data] == _OTHER) | (data == 0x27)
    lead = data == 0xC3
    follows = np.zeros(len(data), dtype=bool)
    follows[1:] = lead[:-1] & ((data[1:] & 0xC0) == 0x80)
    bad[lead | follows] = False
    if len(data):
        bad[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    return np.diff(np.append(0, np.cumsum(bad))[bounds]) == 0


def lowered(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower-cased bytes, class of each byte) of plain text."""
    low, kind = ts.LOWER[data], _CLASS[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    byte = data[second]
    low[second[(byte >= 0x80) & (byte <= 0x9E) & (byte != 0x97)]] += 0x20
    letter = np.where((byte == 0x97) | (byte == 0xB7), _SIGN, _LETTER).astype(np.uint8)  # the signs for times and divided by
    kind[second] = letter
    kind[second - 1] = letter
    return low, kind


def pieces_of(kind: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of runs of letters, runs of signs, and single digits."""
    if not len(kind):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.ones(len(kind), dtype=bool)
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    new[bounds[:-1][bounds[:-1] < len(kind)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(kind))
    real = kind[starts] != _SPACE
    return starts[real], ends[real]


def hilbert(axes: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of points with integer coordinates of ``bits`` bits: the coordinates are turned
    to their transposed index (Skilling's method) and their bits interleaved."""
    x = axes.astype(np.int64).copy()
    n = x.shape[1]
    bit = 1 << bits - 1
    while bit > 1:
        low = bit - 1
        for i in range(n):
            on = (x[:, i] & bit) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), dtype=np.int64)
    bit = 1 << bits - 1
    while bit > 1:
        flip ^= np.where(x[:, n - 1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), dtype=np.int64)
    for b in reversed(range(bits)):
        for i in range(n):
            key = key << 1 | (x[:, i] >> b & 1)
    return key


def curve_places(vectors: np.ndarray) -> np.ndarray:
    """Place on the curve of every row of counts. A coordinate of a unit vector under the projection
    is about normal; its distribution function spreads it over the axis."""
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    x = vectors / np.where(norm > 0, norm, 1) @ _PROJECTION
    share = 1 / (1 + np.exp(-1.702 * x))  # close to the normal distribution function
    return hilbert(np.minimum((share * (1 << AXIS_BITS)).astype(np.int64), (1 << AXIS_BITS) - 1), AXIS_BITS)


_encoders: dict[str, Encoder] = {}


def _encode(path: str):
    def run(batches):
        encoder = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
        for batch, data, bounds in ts.slices(batches, "text", ts.SLICE_BYTES // 2):
            ids, edges, vectors = encoder(data, bounds)
            binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer((2 * edges).astype(np.int64)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(curve_places(vectors)), pa.array(np.diff(edges)), binary.cast(pa.binary())],
                                             names=["id", "curve", "n", "ids"])
    return run


def _cut(places: dict[int, int], size: int):
    """mapInArrow body over one range in curve order: (id, n, ids, range) -> PIECES."""
    def run(batches):
        at = None
        for batch in batches:
            rows = {c: [] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for doc_id, n, ids, part in zip(*(batch.column(i).to_pylist() for i in range(4))):
                at = places[part] if at is None else at
                start = 0
                while start < n:
                    sequence, offset = divmod(at, size)
                    length = min(n - start, size - offset)
                    piece = ids[2 * start:2 * (start + length)]
                    for c, v in zip(rows, (doc_id, start, length, zlib.crc32(np.frombuffer(piece, "<u2").astype("<u4").tobytes()), n, sequence, offset, piece)):
                        rows[c].append(v)
                    at += length
                    start += length
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in rows.items()], names=list(rows))
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, size: int = SEQUENCE) -> DataFrame:
    """PIECES: one row per piece of a document in a sequence of ``size`` tokens; ``ids`` holds its
    token ids as little-endian unsigned 16-bit numbers."""
    spark = docs.sparkSession
    n_ranges = partitions(spark)
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    tie = F.crc32(F.coalesce(F.col("id"), F.lit(-1)).cast("string").cast("binary")).bitwiseAND((1 << 22) - 1)
    encoded = stored(slim.mapInArrow(_encode(tokenizer), ENCODED)).withColumn("key", F.shiftleft("curve", 22).bitwiseOR(tie))
    cuts = encoded.agg(F.percentile_approx("key", [i / n_ranges for i in range(1, n_ranges)], 100 * n_ranges).alias("cuts")).first()["cuts"] if n_ranges > 1 else []
    ranger = _ranger(np.array(sorted(set(cuts or [])), dtype=np.int64))
    sums = encoded.select("key", "n").mapInArrow(ranger, "key bigint, n bigint, range int").groupBy("range").agg(F.sum("n").alias("n"))
    totals = {r["range"]: r["n"] for r in sums.collect()}  # a row per range
    places, at = {}, 0
    for r in sorted(totals):
        places[r] = at
        at += totals[r]
    ranged = encoded.select("key", "id", "n", "ids").mapInArrow(ranger, "key bigint, id bigint, n bigint, ids binary, range int")
    ordered = ranged.repartitionById(n_ranges, F.col("range")).sortWithinPartitions("key", "id", "ids")
    return ordered.select("id", "n", "ids", "range").mapInArrow(_cut(places, size), PIECES)


def _ranger(edges: np.ndarray):
    """mapInArrow body: adds the number of edges below each row's key (its first column)."""
    def run(batches):
        for batch in batches:
            at = np.searchsorted(edges, batch.column(0).to_numpy(zero_copy_only=False)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*batch.schema.names, "range"])
    return run
