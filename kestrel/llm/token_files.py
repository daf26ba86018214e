"""Token ids of a corpus in shards of wavelet matrices (see ``wavelet``), and what can be asked of them.

Writing: every text is encoded once with a byte-level tokenizer and gets an end id. Documents are
range-partitioned in the order null ids, id, text mark, ids, so one id that many rows share
spreads over ranges by its texts. Each task cuts its documents into shards of about SHARD_TOKENS
ids (whole documents; a longer one is a shard of its own), builds a shard's file, and notes the
ids of its range before it. Spark's
committer writes the files, one row each, so a lost executor leaves no half-written shard.

Reading: a shard's place in the corpus is the sum of the ids of all earlier ranges (a total per
range) and of those before it in its own. ``documents`` reads every document back,
``access``, ``counts`` and ``occurrences`` look ids up inside the compressed files.

Tokenising: texts of ASCII and Latin-1 letters without special-token strings are cut into the
pieces of the tokenizer's pattern by array operations, and only pieces not met before (byte for
byte) are encoded; all other texts go to the tokenizer as a whole. Both give the tokenizer's own ids.

Defined results: null text is empty and gives the end id alone; rows with null or repeated ids are
all written, nulls first; rows alike in id and text follow one another; an empty table gives no
shard and an empty result; other columns are ignored; texts have any length.
"""

from __future__ import annotations

import uuid
import zlib
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kestrel.llm import textscan as ts, wavelet
from kestrel.llm.common import partitions, shared_folder, stored
from kestrel.llm.curve_packing import tokenizer_at

TOKENIZER = "byte_bpe_50k.json"
END = 2
SHARD_TOKENS = 1 << 18
CACHE_PIECES = 1 << 20  # a Python worker forgets its pieces beyond that many

ENCODED = "id bigint, mark bigint, ids binary"
SHARDS = "part int, shard int, before bigint, n_tokens bigint, n_docs bigint, file binary"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

#: Fixed values of the tokenizer's pattern: its contractions.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

_OTHER, _SPACE, _LETTER, _DIGIT, _SIGN = range(5)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE

#: How byte-level tokenizers write a byte as a character: printable ones as themselves, the others from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_WRITTEN = np.arange(256, dtype="<u2")
_WRITTEN[[b for b in range(256) if b not in _PRINTED]] = 0x100 + np.arange(256 - len(_PRINTED))

_ODD_BASE = 0x9E3779B97F4A7C15
_odd_powers: list[np.ndarray] = []


def piece_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Quick hashes of byte ranges (a polynomial modulo 2**64); whoever finds them equal compares the bytes."""
    n = len(data) + 1
    if not _odd_powers or len(_odd_powers[0]) < n:
        _odd_powers[:] = [np.full(max(n, 1 << 20), base, dtype=np.uint64) for base in (_ODD_BASE, pow(_ODD_BASE, -1, 1 << 64))]
        for factors in _odd_powers:
            factors[0] = 1
            np.cumprod(factors, out=factors)
    up, down = _odd_powers
    prefix = np.zeros(n, dtype=np.uint64)
    np.cumsum(ts.byte_values(data) * up[:n - 1], out=prefix[1:])
    return ts.mix((prefix[ends] - prefix[starts]) * down[starts])


def kinds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kind of every byte, documents of which array operations may cut the pieces): those of
    printable ASCII, white space and U+00C0 to U+00FF, without a special token's `<|`."""
    kind = _KIND[data]
    second = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] & 0xC0) == 0x80)) + 1
    letter = np.where((data[second] == 0x97) | (data[second] == 0xB7), _SIGN, _LETTER).astype(np.uint8)  # the signs for times and divided by
    kind[second] = letter
    kind[second - 1] = letter
    bad = kind == _OTHER
    if len(data):
        bad[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    if not bad.any():
        return kind, np.ones(len(bounds) - 1, dtype=bool)
    return kind, np.diff(np.append(0, np.cumsum(bad))[bounds]) == 0


def pieces(data: np.ndarray, kind: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the pattern's pieces: runs of letters, digits or signs with the one blank before
    them, contractions, and the white space left over."""
    if not len(kind):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.append(True, kind[1:] != kind[:-1])
    new[bounds[:-1][bounds[:-1] < len(kind)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(kind))
    of = kind[starts]
    opens = np.zeros(len(kind) + 1, dtype=bool)
    opens[bounds] = True
    joins = ~opens[starts[1:]]                       # the run goes on from the one before, in one document
    blank = (of == _SPACE) & (data[ends - 1] == 0x20)
    follows = np.append(False, joins)
    before_blank = np.append(False, blank[:-1]) & follows & (of != _SPACE)
    # contractions: an apostrophe by itself, no blank before it, and certain letters after it
    begin, cut = starts - before_blank, np.zeros(len(starts), dtype=np.int64)
    lone = np.flatnonzero((of[:-1] == _SIGN) & (ends[:-1] - starts[:-1] == 1) & (data[starts[:-1]] == 0x27) & ~before_blank[:-1]
                          & joins & (of[1:] == _LETTER))
    if len(lone):
        size = ends[lone + 1] - starts[lone + 1]
        one = data[starts[lone + 1]]
        two = np.where(size > 1, data[np.minimum(starts[lone + 1] + 1, len(data) - 1)], 0)
        taken = np.zeros(len(lone), dtype=np.int64)
        for text in CONTRACTIONS:
            letters = text[1:].encode()
            taken[(one == letters[0]) & ((two == letters[1]) if len(letters) > 1 else True)] = len(letters)
        cut[lone + 1] = taken
    ends_of = ends + np.append(cut[1:], 0)           # the apostrophe takes its letters
    begin = begin + cut
    words = (of != _SPACE) & (ends_of > begin)
    # white space: its last character stands apart if a run follows; a blank has gone to that run
    white = of == _SPACE
    last = white & np.append(joins, False)
    left = np.where(last, ends - 1, ends)
    whole = white & (left > starts)
    single = last & ~blank
    out_starts = np.concatenate([begin[words], starts[whole], ends[single] - 1])
    out_ends = np.concatenate([ends_of[words], left[whole], ends[single]])
    order = np.argsort(out_starts, kind="stable")
    return out_starts[order], out_ends[order]


class Encoder:
    """ids of many texts at once; pieces are remembered with their bytes."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer_at(path)
        self.forget()

    def forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.place, self.size, self.raw_at, self.raw_size = (np.empty(0, np.int64) for _ in range(4))
        self.pool, self.raw = np.empty(0, np.uint16), np.empty(0, np.uint8)

    def ids_of(self, texts: list[bytes]) -> list[list[int]]:
        """The ids of single pieces: what is left of the tokenizer's work once the pattern has cut."""
        tokenize, number = self.tokenizer.model.tokenize, attrgetter("id")
        written = _WRITTEN[np.frombuffer(b"".join(texts), np.uint8)].tobytes().decode("utf-16-le")
        out, at = [], 0
        for text in texts:
            out.append(list(map(number, tokenize(written[at:at + len(text)]))))
            at += len(text)
        return out

    def learn(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        ids = self.ids_of(texts)
        size, raw_size = (np.array([len(x) for x in xs], dtype=np.int64) for xs in (ids, texts))
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        for name, new in (("place", len(self.pool) + np.cumsum(size) - size), ("size", size),
                          ("raw_at", len(self.raw) + np.cumsum(raw_size) - raw_size), ("raw_size", raw_size)):
            setattr(self, name, np.concatenate([getattr(self, name), new])[order])
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), np.uint16)])
        self.raw = np.concatenate([self.raw, np.frombuffer(b"".join(texts), np.uint8)])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, hashes)
        at[at == len(self.known)] = 0
        return np.where(self.known[at] == hashes, at, -1) if len(self.known) else np.full(len(hashes), -1)

    def differ(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether each piece has other bytes than the one remembered under its hash."""
        size = ends - starts
        wrong = size != self.raw_size[at]
        step = np.arange(size.sum(), dtype=np.int32)
        before = np.cumsum(size) - size
        here = np.repeat((starts - before).astype(np.int32), size) + step
        there = np.repeat((self.raw_at[at] - before).astype(np.int32), size) + step
        other = data[here] != self.raw[np.minimum(there, max(len(self.raw) - 1, 0), out=there)]
        if other.any():
            wrong[np.repeat(np.arange(len(size)), size)[other]] = True
        return wrong

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, each with its end id, their bounds)."""
        n_docs = len(bounds) - 1
        kind, plain = kinds(data, bounds)
        starts, ends = pieces(data, kind, bounds)
        doc = np.repeat(np.arange(n_docs), np.diff(np.searchsorted(starts, bounds)))
        if not plain.all():
            use = plain[doc]
            starts, ends, doc = starts[use], ends[use], doc[use]
        hashes = piece_hashes(data, starts, ends)
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_PIECES:
            self.forget()
        new = np.flatnonzero(self.find(unique) < 0)
        if len(new):
            flat = data.tobytes()
            self.learn(unique[new], [flat[starts[i]:ends[i]] for i in first[new]])
        at = self.find(unique)[back]
        wrong = self.differ(data, starts, ends, at)
        if wrong.any():
            plain[doc[wrong]] = False
            doc, at = doc[plain[doc]], at[plain[doc]]
        place, size = self.place[at], self.size[at]
        total = np.bincount(doc, weights=size, minlength=n_docs).astype(np.int64)
        inner = total.copy()
        whole: dict[int, np.ndarray] = {}
        for d in np.flatnonzero(~plain):
            text = data[bounds[d]:bounds[d + 1]].tobytes().decode("utf-8", "replace")
            whole[d] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint16)
            total[d] = len(whole[d])
        edges = np.append(0, np.cumsum(total + 1))
        out = np.full(edges[-1], END, dtype=np.uint16)
        step = np.arange(size.sum(), dtype=np.int32)
        source = np.repeat((place - (np.cumsum(size) - size)).astype(np.int32), size) + step
        target = step + np.repeat((edges[:-1] - (np.cumsum(inner) - inner)).astype(np.int32), inner)
        out[target] = self.pool[source]
        for d, ids in whole.items():
            out[edges[d]:edges[d] + len(ids)] = ids
        return out, edges


_encoders: dict[str, Encoder] = {}


def _encode(path: str):
    def run(batches):
        encoder = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
        for batch, data, bounds in ts.slices(batches, "text", ts.SLICE_BYTES // 2):
            ids, edges = encoder(data, bounds)
            binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer((2 * edges).astype(np.int64)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), binary.cast(pa.binary())], names=["id", "mark", "ids"])
    return run


def _shards(size: int):
    """mapInArrow body over one range of documents in order: (part, id, ids) -> SHARDS."""
    def run(batches):
        part, number, before, held, rows, n = None, 0, 0, [], [], 0

        def file():
            documents = np.array(rows, dtype=wavelet.DOCUMENT)
            raw = wavelet.encode(np.concatenate(held), documents)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([n], pa.int64()),
                 pa.array([len(rows)], pa.int64()), pa.array([raw], pa.binary())], names=["part", "shard", "before", "n_tokens", "n_docs", "file"])

        for batch in batches:
            parts, ids = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                part = parts[i].as_py() if part is None else part
                tokens = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint16)
                if rows and n + len(tokens) > size:
                    yield file()
                    number, before, held, rows, n = number + 1, before + n, [], [], 0
                held.append(tokens.copy())
                rows.append((ids[i].as_py() or 0, not ids[i].is_valid, len(tokens)))
                n += len(tokens)
        if rows:
            yield file()
    return run


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the ids of all documents, in ascending id order, as shards under ``path``."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    encoded = stored(slim.mapInArrow(_encode(tokenizer), ENCODED))
    ordered = (encoded.repartitionByRange(partitions(spark), "id", "mark").sortWithinPartitions("id", "mark", "ids")
               .select(F.spark_partition_id().alias("part"), "id", "ids"))
    # the files are compressed already
    ordered.mapInArrow(_shards(shard_tokens), SHARDS).write.option("compression", "none").parquet(path)


def shards(spark, path: str) -> DataFrame:
    """SHARDS and ``first``: the number of ids in all shards before."""
    read = spark.read.schema(SHARDS).parquet(path)
    totals = {r["part"]: r["n"] for r in read.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}  # a row per range
    base, at = [], 0
    for part in sorted(totals):
        base.append((part, at))
        at += totals[part]
    return (read.join(F.broadcast(spark.createDataFrame(base, "part int, base bigint")), "part")  # a row per range
            .withColumn("first", F.col("base") + F.col("before")).drop("base"))


def _each_shard(names: list[str], rows_of):
    """mapInArrow body over (first, file): ``rows_of(shard, first)`` gives a shard's columns."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard = wavelet.Shard(batch.column(1)[i].as_buffer())
                columns = rows_of(shard, batch.column(0)[i].as_py())
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names=names)
        ts.give_back()
    return run


def _ids_of(shard: wavelet.Shard, which: np.ndarray) -> pa.Array:
    return pa.array(shard.documents["id"][which], pa.int64(), mask=shard.documents["null"][which].astype(bool))


def documents(files: DataFrame) -> DataFrame:
    """DOCUMENTS of ``shards``: every document's ids read back from the files."""
    def rows_of(shard, first):
        tokens = shard.tokens().astype("<u4")
        sums = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(shard.starts[:-1], shard.starts[1:])]
        return _ids_of(shard, np.arange(len(shard.documents))), first + shard.starts[:-1], shard.documents["n"], np.array(sums, dtype=np.int64)

    return files.select("first", "file").mapInArrow(_each_shard(["doc_id", "start", "n_tokens", "ids_crc32"], rows_of), DOCUMENTS)


def counts(files: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of the tokens stands in the corpus."""
    wanted = sorted(set(tokens))

    def rows_of(shard, first):
        return np.array(wanted, dtype=np.int64), np.array([shard.count(t) for t in wanted], dtype=np.int64)

    each = files.select("first", "file").mapInArrow(_each_shard(["token", "n"], rows_of), "token bigint, n bigint")
    return each.groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(files: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, place, doc_id, offset): every occurrence of the tokens, by its place in the corpus and in its document."""
    wanted = sorted(set(tokens))

    def rows_of(shard, first):
        found = [shard.occurrences(t) for t in wanted]
        places = np.concatenate([np.empty(0, np.int64), *found])
        which = shard.document_of(places)
        return np.repeat(np.array(wanted, dtype=np.int64), [len(f) for f in found]), first + places, _ids_of(shard, which), places - shard.starts[which]

    return files.select("first", "file").mapInArrow(_each_shard(["token", "place", "doc_id", "offset"], rows_of),
                                                    "token bigint, place bigint, doc_id bigint, offset bigint")


def access(files: DataFrame, places: DataFrame) -> DataFrame:
    """(place, token) for the places (column ``place``) that the corpus has. Places meet their shards by
    range of SHARD_TOKENS ids, and each shard decompresses only the blocks they lie in."""
    cells = files.select("first", "n_tokens", "file").withColumn(
        "cell", F.explode(F.sequence(F.expr(f"first div {SHARD_TOKENS}"), F.expr(f"(first + n_tokens - 1) div {SHARD_TOKENS}"))))
    wanted = places.select(F.col("place").cast("bigint").alias("place")).distinct().withColumn("cell", F.expr(f"place div {SHARD_TOKENS}"))
    met = (cells.drop("file").join(wanted, "cell").filter("place >= first and place < first + n_tokens")
           .groupBy("first").agg(F.collect_list(F.expr("place - first")).alias("inside")))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                first, shard = batch.column(0)[i].as_py(), wavelet.Shard(batch.column(1)[i].as_buffer())
                inside = sorted(batch.column(2)[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array([first + p for p in inside], pa.int64()), pa.array([shard.access(p) for p in inside], pa.int64())],
                                                 names=["place", "token"])

    return files.select("first", "file").join(met, "first").mapInArrow(run, "place bigint, token bigint")


def fresh_path(spark) -> str:
    """A new folder for shards in the folder all executors share."""
    return f"{shared_folder(spark)}/shards/{uuid.uuid4().hex}"
