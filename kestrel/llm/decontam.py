"""Benchmark decontamination by greedy string tiling with Karp-Rabin seeds.

Tokens are runs of letters and digits, A-Z lower-cased. Every run of ``MIN_MATCH`` tokens has a
Karp-Rabin hash; a document and a benchmark item meet where they share such a seed (a join on
the hash). For each pair that meets often enough, tiling repeatedly marks the longest match that
touches no marked token, on either side, until none of MIN_MATCH tokens is left. The share of the
item's tokens under tiles is its coverage, so passages whose parts were reordered, or that were
cut up by insertions, still count in full. A pair with coverage >= THRESHOLD is a leak.

Before the join a bitmap of fixed size, with the hashes of all benchmark seeds, thins out the
documents' seeds; whatever passes by chance finds no partner in the join. The benchmark itself is
never broadcast by a hint.

Defined results: null texts and items are empty; an item with fewer than MIN_MATCH tokens has no
seed and leaks nowhere; rows that repeat a doc_id or item_id are tiled one by one and the pair
carries its best coverage; null ids are kept as an id of their own; empty tables give an empty
result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kestrel.llm import textscan as ts
from kestrel.llm.common import stored

MIN_MATCH = 5
THRESHOLD = 0.5
LISTED_MATCHES = 1 << 14  # of seeds of one text and one item that are listed one by one
FILTER_BITS = 1 << 23  # 1 MB, whatever the size of the benchmark

#: Everything but ASCII letters, digits and non-ASCII bytes separates tokens.
BREAKS = np.ones(256, dtype=bool)
BREAKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

SEEDED = "id bigint, row bigint, n_tokens int, at array<int>, seeds array<bigint>"
TILED = "id bigint, item bigint, coverage double, n_tiles int, longest int, item_tokens int"


def seeds_of(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, ts.Words]:
    """(hash, document, token position) of every run of k tokens, and the tokens."""
    words = ts.Words(data, bounds, BREAKS)
    grams = ts.kgrams(ts.word_hashes(data, words, ts.LOWER), k)
    at = np.flatnonzero(words.doc[:len(grams)] == words.doc[k - 1:]) if len(grams) else np.empty(0, np.int64)
    doc = words.doc[at]
    return grams[at], doc, at - words.first[doc], words


def _seeder(k: int, bitmap: np.ndarray | None):
    """mapInArrow body: (id, text) -> SEEDED, only seeds in the bitmap and rows that have any."""
    def run(batches):
        for batch, data, bounds in ts.slices(batches, "text"):
            seeds, doc, at, words = seeds_of(data, bounds, k)
            if bitmap is not None:
                bit = seeds & np.uint64(FILTER_BITS - 1)
                hit = (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                seeds, doc, at = seeds[hit], doc[hit], at[hit]
            n_docs = len(bounds) - 1
            ends = np.searchsorted(doc, np.arange(n_docs + 1)).astype(np.int32)
            rows = np.flatnonzero(np.diff(ends))
            if not len(rows):
                continue
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), ts.text_marks(data, bounds), pa.array(np.diff(words.first).astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(seeds.view(np.int64)))],
                names=["id", "row", "n_tokens", "at", "seeds"])
            yield out.take(pa.array(rows))
    return run


def seed_bitmap(seeds: DataFrame) -> np.ndarray:
    """Bitmap of (seed): at most FILTER_BITS / 8 rows reach the driver."""
    bit = F.col("seed").bitwiseAND(FILTER_BITS - 1)
    words = seeds.select((bit / 8).cast("int").alias("byte"), F.expr(f"shiftleft(1, cast((seed & {FILTER_BITS - 1}) % 8 as int))").alias("bit"))
    got = words.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    out[got["byte"].to_numpy()] = got["bits"].to_numpy()
    return out


def tile(doc_at: np.ndarray, doc_seeds: np.ndarray, item_at: np.ndarray, item_seeds: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, document start, tokens), longest first. Ties: earlier in the item, then
    earlier in the document. Few shared seeds are listed as matches; where they are many (what repeats in both
    makes their number a product) the lengths are tried instead. Both give the same tiles."""
    order = np.argsort(doc_seeds, kind="stable")
    low = np.searchsorted(doc_seeds, item_seeds, side="left", sorter=order)
    n = np.searchsorted(doc_seeds, item_seeds, side="right", sorter=order) - low
    if n.sum() > LISTED_MATCHES:
        return tile_by_length(doc_at, doc_seeds, item_at, item_seeds, k)
    where = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return tile_by_matches(np.repeat(item_at, n).astype(np.int64), doc_at[order[where]].astype(np.int64), k)


def tile_by_matches(i: np.ndarray, d: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The same from matches of seeds (place in the item, place in the document): runs on a diagonal compete by length."""
    order = np.lexsort((i, d - i))
    i, d = i[order], d[order]
    new = np.append(True, ((d - i)[1:] != (d - i)[:-1]) | (i[1:] != i[:-1] + 1))[:len(i)]
    cut = np.flatnonzero(new)
    length = np.diff(np.append(cut, len(i))) + k - 1
    heap = [(-int(n), int(a), int(b)) for n, a, b in zip(length, i[cut], d[cut])]
    heapq.heapify(heap)
    item_marks, doc_marks, tiles = set(), set(), []
    while heap:
        n, a, b = heapq.heappop(heap)
        free = [a + j not in item_marks and b + j not in doc_marks for j in range(-n)]
        if all(free):
            tiles.append((a, b, -n))
            item_marks.update(range(a, a - n))
            doc_marks.update(range(b, b - n))
            continue
        begin = 0
        for j, ok in enumerate([*free, False]):  # the free stretches compete again, with their own lengths
            if not ok:
                if j - begin >= k:
                    heapq.heappush(heap, (begin - j, a + begin, b + begin))
                begin = j + 1
    return tiles


def tile_by_length(doc_at: np.ndarray, doc_seeds: np.ndarray, item_at: np.ndarray, item_seeds: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Running Karp-Rabin by falling length: the longest common run of unmarked tokens is found by bisection
    over its length, whose window hashes either side has or has not; then all matches of that length are
    marked in order. Memory is that of text and item, whatever repeats in them, and no length is tried twice."""
    order = np.argsort(doc_at, kind="stable")
    sides = [(np.asarray(at, dtype=np.int64), np.asarray(seeds).astype(np.int64).view(np.uint64)) for at, seeds in ((item_at, item_seeds), (doc_at[order], doc_seeds[order]))]
    sides = [(at[keep], seeds[keep]) for (at, seeds), keep in zip(sides, (np.isin(sides[0][1], sides[1][1]), np.isin(sides[1][1], sides[0][1])))]
    if not len(sides[0][0]) or not len(sides[1][0]):
        return []
    marks = [np.zeros(int(at[-1]) + k, dtype=bool) for at, _ in sides]

    def windows(side: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of the unmarked runs of ``length`` tokens whose seeds are all there."""
        at, seeds = sides[side]
        n = length - k + 1  # seeds of a run
        if len(at) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        first = np.arange(len(at) - n + 1)
        marked = np.append(0, np.cumsum(marks[side]))
        first = first[(at[first + n - 1] - at[first] == n - 1) & (marked[at[first] + length] == marked[at[first]])]
        return at[first], ts.range_hashes(seeds, first, first + n)

    tiles: list[tuple[int, int, int]] = []
    longest = int(min(len(sides[0][0]), len(sides[1][0]))) + k - 1
    while longest >= k:
        low, high = k - 1, longest  # a match of ``low`` tokens is known (or none is)
        while low < high:
            middle = (low + high + 1) // 2
            (_, mine), (_, other) = windows(0, middle), windows(1, middle)
            if len(mine) and len(other) and np.isin(mine, other).any():
                low = middle
            else:
                high = middle - 1
        if low < k:
            break
        (starts, hashes), (doc_starts, doc_hashes) = windows(0, low), windows(1, low)
        group = np.argsort(doc_hashes, kind="stable")
        left = np.searchsorted(doc_hashes[group], hashes, side="left")
        right = np.searchsorted(doc_hashes[group], hashes, side="right")
        passed: dict[int, int] = {}  # of each hash, the document's places already used up
        for a, begin, end in zip(starts.tolist(), left.tolist(), right.tolist()):
            if begin == end or marks[0][a:a + low].any():
                continue
            at = passed.get(begin, begin)
            while at < end and marks[1][doc_starts[group[at]]:doc_starts[group[at]] + low].any():
                at += 1
            passed[begin] = at
            if at < end:
                b = int(doc_starts[group[at]])
                marks[0][a:a + low] = marks[1][b:b + low] = True
                tiles.append((a, b, low))
        longest = low - 1  # what is left of this length is marked
    return tiles


def _tiler(k: int):
    def run(batches):
        for batch in batches:
            rows = batch.to_pydict()
            out = []
            for j in range(batch.num_rows):
                tiles = tile(np.asarray(rows["at"][j]), np.asarray(rows["seeds"][j], dtype=np.int64), np.asarray(rows["item_at"][j]),
                             np.asarray(rows["item_seeds"][j], dtype=np.int64), k)
                out.append((rows["id"][j], rows["item"][j], sum(t[2] for t in tiles) / rows["item_tokens"][j], len(tiles),
                            max((t[2] for t in tiles), default=0), rows["item_tokens"][j]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()))],
                    names=["id", "item", "coverage", "n_tiles", "longest", "item_tokens"])
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", k: int = MIN_MATCH, threshold: float = THRESHOLD) -> DataFrame:
    """TILED: one row per (document id, item id) whose coverage reaches the threshold."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("bigint").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    items = stored(items.mapInArrow(_seeder(k, None), SEEDED).select(
        F.col("id").alias("item"), F.col("row").alias("item_row"), F.col("n_tokens").alias("item_tokens"),
        F.col("at").alias("item_at"), F.col("seeds").alias("item_seeds")).distinct())
    lookup = (items.select("item", "item_row", "item_tokens", F.explode("item_seeds").alias("seed"))
              .groupBy("item", "item_row", "item_tokens", "seed").agg(F.count("*").alias("times")))
    found = stored(slim.mapInArrow(_seeder(k, seed_bitmap(lookup)), SEEDED).distinct())
    met = (found.select("id", "row", F.explode(F.array_distinct("seeds")).alias("seed")).join(lookup, "seed")
           .groupBy("id", "row", "item", "item_row").agg(F.sum("times").alias("shared"), F.first("item_tokens").alias("item_tokens"))
           # each occurrence of a shared seed covers at most k tokens of the item
           .filter(F.col("shared") * k >= threshold * F.col("item_tokens")).drop("item_tokens"))
    pairs = (met.alias("m").join(found.alias("d"), F.expr("m.id <=> d.id and m.row = d.row"))
             .join(items.alias("i"), F.expr("m.item <=> i.item and m.item_row = i.item_row"))
             .select("m.id", "d.at", "d.seeds", "m.item", "i.item_at", "i.item_seeds", "i.item_tokens"))
    tiled = pairs.mapInArrow(_tiler(k), TILED).filter(F.col("coverage") >= threshold)
    best = tiled.groupBy("id", "item").agg(F.max(F.struct("coverage", "n_tiles", "longest", "item_tokens")).alias("best"))
    return best.select("id", "item", "best.*")
