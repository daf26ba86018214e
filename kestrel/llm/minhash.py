"""Near-duplicate detection with b-bit MinHash.

A document's set holds the hashes of its distinct word shingles. The low 8 bits of BANDS * ROWS
minima are kept; ROWS neighbouring bytes are a band's key. Documents with equal sets form a class
first, and one stands for it. Classes that share a band key are candidates. For these a finer
signature keeps the low 2 bits of LANES minima, packed: XOR, fold every lane to one bit, count
bits. Unrelated lanes agree once in four, so the share p of equal lanes gives J = (p - 1/4) / (3/4).
Pairs estimated more than MARGIN standard deviations below the threshold are dropped, all others
are confirmed on their full sets.

Not all pairs of a band are looked at, and yet no link between components is lost:
1. Stars: in each band every class is compared with one of it, the same where possible.
   Confirmed links give components.
2. Nearest: in bands with several components every class is compared with the one of another
   component that its signature is closest to.
3. Rest: only pairs whose components still differ can change the result. They are all compared by
   signature (classes of a band's largest component only with those outside), and what passes is
   confirmed. Their links complete the components.
Bands of more than BLOCK classes are cut into cells of two blocks for 2 and 3. A pair that meets
in several bands counts in the first.

With 30 bands of 5 rows a pair at similarity 0.85 shares a band but for 2 in 10**8.

Defined results: fewer words than a shingle make one shingle of all words; documents without
words (null and blank text among them) have an empty set, are linked with nothing, and stay; null
and repeated ids are told apart as in ``common.keyed``, rows that repeat id and text share one
result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kestrel.llm import textscan as ts
from kestrel.llm.common import KEY, keyed, partitions, sieved, stored

SHINGLE = 5
PERCENT = 80      # similarity from which two documents are linked
BANDS, ROWS = 30, 5
LANES = 1024        # 2-bit minima of the finer signature
MARGIN = 5.0        # standard deviations
BLOCK = 1024      # classes of a band compared at once

_rng = np.random.Generator(np.random.PCG64(11))
_MULTIPLY = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_FINE_MULTIPLY = _rng.integers(0, 1 << 32, LANES, dtype=np.uint32) | np.uint32(1)
_FINE_ADD = _rng.integers(0, 1 << 32, LANES, dtype=np.uint32)
_ODD_BITS = np.uint64(0x5555555555555555)

SKETCH = f"{KEY} bigint, n bigint, d1 bigint, d2 bigint, signature binary, bands array<bigint>"


def shingle_sets(data: np.ndarray, bounds: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of each document, sorted."""
    words = ts.Words(data, bounds)
    hashes = ts.word_hashes(data, words, ts.LOWER)
    grams = ts.kgrams(hashes, shingle)
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < shingle))
    whole = dict(zip(short.tolist(), ts.range_hashes(hashes, words.first[short], words.first[short + 1])))
    sets = []
    for d, (a, n) in enumerate(zip(words.first[:-1].tolist(), count.tolist())):
        sets.append(np.unique(grams[a:a + n - shingle + 1]) if n >= shingle else np.array([whole[d]] if n else [], dtype=np.uint64))
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.append(0, np.cumsum([len(s) for s in sets], dtype=np.int64))


def minima(hashes: np.ndarray, starts: np.ndarray, multiply: np.ndarray, add: np.ndarray):
    """One array of minima (of each not empty set) per hash function."""
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    values = np.empty_like(small)
    for a, b in zip(multiply, add):
        np.multiply(small, a, out=values)
        np.add(values, b, out=values)
        yield np.minimum.reduceat(values, starts)


def signatures(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, BANDS * ROWS) uint8: the low 8 bits of the minima."""
    out = np.empty((len(starts), BANDS * ROWS), dtype=np.uint8)
    for j, least in enumerate(minima(hashes, starts, _MULTIPLY, _ADD)):
        out[:, j] = least & np.uint32(255)
    return out


def fine_signatures(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, LANES / 4) uint8: the low 2 bits of the minima, four to a byte."""
    out = np.zeros((len(starts), LANES // 4), dtype=np.uint8)
    for j, least in enumerate(minima(hashes, starts, _FINE_MULTIPLY, _FINE_ADD)):
        out[:, j // 4] |= ((least & np.uint32(3)) << np.uint32(2 * (j % 4))).astype(np.uint8)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(sets, BANDS) int64: a band's ROWS bytes above its number."""
    rows = signature.reshape(len(signature), BANDS, ROWS).astype(np.int64)
    key = np.zeros((len(signature), BANDS), dtype=np.int64)
    for j in range(ROWS):
        key = key << 8 | rows[:, :, j]
    return key << 8 | np.arange(BANDS)


def _sketcher(shingle: int):
    def run(batches):
        for batch, data, bounds in ts.slices(batches, "text"):
            hashes, edges = shingle_sets(data, bounds, shingle)
            n = np.diff(edges)
            some = np.flatnonzero(n)
            if not len(some):
                yield _sketches(batch.column(0), n, some, np.empty(0, np.uint64), np.empty((0, BANDS * ROWS), np.uint8))
                continue
            digests = np.add.reduceat(ts.mix(hashes), edges[some])
            yield _sketches(batch.column(0), n, some, np.stack([digests, np.add.reduceat(ts.mix(hashes ^ ts.U64(0x9E3779B97F4A7C15)), edges[some])]),
                            signatures(hashes, edges[some]))
    return run


def _sketches(keys, n, some, digests, signature):
    size = len(n)
    d = np.zeros((2, size), dtype=np.uint64)
    sig = [None] * size
    if len(some):
        d[:, some] = digests
        for i, row in zip(some.tolist(), signature):
            sig[i] = row.tobytes()
    keys_of = band_keys(signature).reshape(-1)
    lengths = np.zeros(size, dtype=np.int32)
    lengths[some] = BANDS
    bands = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(keys_of))
    return pa.RecordBatch.from_arrays([keys, pa.array(n), pa.array(d[0].view(np.int64)), pa.array(d[1].view(np.int64)), pa.array(sig, pa.binary()), bands],
                                      names=[KEY, "n", "d1", "d2", "signature", "bands"])


def _set_reader(shingle: int):
    def run(batches):
        for batch, data, bounds in ts.slices(batches, "text"):
            hashes, edges = shingle_sets(data, bounds, shingle)
            fine = fine_signatures(hashes, edges[:-1])  # representatives have a shingle at least
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(hashes.view(np.int64))),
                                              pa.array([row.tobytes() for row in fine], pa.binary())], names=["rep", "shingles", "fine"])
    return run


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of fine signatures as 64-bit words (last axis; shapes broadcast)."""
    x = a ^ b
    equal = LANES - np.bitwise_count((x | x >> np.uint64(1)) & _ODD_BITS).sum(axis=-1, dtype=np.int64)
    return (equal / LANES - 1 / 4) / (3 / 4)


def least_estimate(percent: int) -> float:
    p = 1 / 4 + 3 / 4 * percent / 100
    return percent / 100 - MARGIN * (p * (1 - p) / LANES) ** 0.5 / (3 / 4)


def _matrix(column) -> np.ndarray:
    """Rows of a binary column of equal lengths as uint8."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)


def _pruner(least: float):
    """mapInArrow body over (a, b, fine signature of a, of b): pairs estimated at ``least`` or more."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sure = estimate(_matrix(batch.column(2)).view(np.uint64), _matrix(batch.column(3)).view(np.uint64)) >= least
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(sure))
    return run


def _cell_pairs(rep, root, size, signature, fine, band: int, least: float, percent: int, nearest: bool):
    """Pairs of one cell whose roots differ and that may be similar: for each class the nearest one,
    or all pairs, those only that meet in no earlier band."""
    names, at, counts = np.unique(root, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return
    main = at == counts.argmax()
    for i in np.flatnonzero(~main):
        # the largest component's classes are met from the other side; other pairs once
        other = (root != root[i]) & (main | (rep > rep[i]) | nearest)
        other &= (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
        other = np.flatnonzero(other)
        close = estimate(fine[i], fine[other])
        if nearest:
            other = other[close.argmax():][:1] if len(other) and close.max() >= least else other[:0]
        else:
            other = other[close >= least]
            meets = (signature[i].reshape(BANDS, ROWS) == signature[other].reshape(-1, BANDS, ROWS)).all(axis=2)
            other = other[meets.argmax(axis=1) == band] if len(other) else other
        if len(other):
            yield np.minimum(rep[i], rep[other]), np.maximum(rep[i], rep[other])


def _cells(least: float, percent: int, nearest: bool):
    """mapInArrow body over rows sorted by (band, cell): the candidate pairs of every cell."""
    def run(batches):
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
            if held is None or not held.num_rows:
                continue
            band, cell = held["band"].to_numpy(), held["cell"].to_numpy()
            cut = np.flatnonzero(np.append(True, (band[1:] != band[:-1]) | (cell[1:] != cell[:-1])))
            edges = np.append(cut, len(band)) if batch is None else cut  # the last cell may go on
            if len(edges) < 2:
                continue
            rep, root, size = (held[c].to_numpy() for c in ("rep", "root", "n"))
            signature = _matrix(held["signature"].slice(0, edges[-1]))
            fine = _matrix(held["fine"].slice(0, edges[-1])).view(np.uint64)
            found = [pair for a, b in zip(edges[:-1], edges[1:]) if b - a > 1
                     for pair in _cell_pairs(rep[a:b], root[a:b], size[a:b], signature[a:b], fine[a:b], int(band[a]) & 255, least, percent, nearest)]
            if found:
                pairs = np.unique(np.stack([np.concatenate([p[0] for p in found]), np.concatenate([p[1] for p in found])]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
            held = held.slice(edges[-1]).combine_chunks()
    return run


def _with_end(batches):
    yield from batches
    yield None


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the smallest node it reaches. Roots
    spread to neighbours and are then replaced by their own roots, so long chains shrink fast."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).union(edges.select("a", "a")).union(edges.select("b", "b")).distinct())
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")))
    total = None
    while True:
        near = (both.join(roots, both.b == roots.node).groupBy("a").agg(F.min("root").alias("root")))
        jump = roots.select(F.col("node").alias("via"), F.col("root").alias("next"))
        roots = stored(near.join(jump, near.root == jump.via).select(F.col("a").alias("node"), F.least("root", "next").alias("root")))
        now = roots.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]  # roots only ever fall
        if now == total:
            return roots
        total = now


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    a = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return (pairs.join(a, "a").join(b, "b").withColumn("shared", shared)
            .filter(100 * F.col("shared") >= percent * (F.size("of_a") + F.size("of_b") - F.col("shared"))).select("a", "b"))


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, shingle: int = SHINGLE,
           keep: list[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The two tables of ``common.keyed``, and (KEY, n_shingles, root), one row per key: documents of
    similarity percent / 100 or more are linked; root is the smallest key of the component."""
    spark = docs.sparkSession
    least = least_estimate(percent)
    own, distinct = keyed(docs, id_col, text_col, keep)
    sketches = stored(distinct.select(KEY, "text").mapInArrow(_sketcher(shingle), SKETCH))
    classes = sketches.filter("n > 0").groupBy("n", "d1", "d2").agg(F.min(KEY).alias("rep"))
    reps = classes.select("rep").join(sketches.select(F.col(KEY).alias("rep"), "n", "signature", "bands"), "rep")
    in_bands = reps.select("rep", F.explode("bands").alias("band"))
    size = in_bands.groupBy("band").agg(F.count("*").alias("m")).filter("m > 1")
    crowded = stored(in_bands.join(size, "band"))
    members = crowded.select("rep").distinct()
    texts = sieved(distinct.select(KEY, "text"), members.select(F.col("rep").alias(KEY)))[0].join(members.select(F.col("rep").alias(KEY)), KEY)
    sets = stored(texts.mapInArrow(_set_reader(shingle), "rep bigint, shingles array<bigint>, fine binary"))
    candidates = stored(reps.select("rep", "n", "signature").join(sets.select("rep", "fine"), "rep"))

    # 1. stars
    star = crowded.withColumn("turn", F.xxhash64("rep"))
    hub = star.groupBy("band").agg(F.min("turn").alias("turn")).join(star, ["band", "turn"]).groupBy("band").agg(F.min("rep").alias("hub"))
    spokes = (star.join(hub, "band").filter("rep != hub").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct())
    sign = candidates.select("rep", "fine")
    likely = (spokes.join(sign.select(F.col("rep").alias("a"), F.col("fine").alias("fa")), "a")
              .join(sign.select(F.col("rep").alias("b"), F.col("fine").alias("fb")), "b")
              .select("a", "b", "fa", "fb").mapInArrow(_pruner(least), "a bigint, b bigint"))
    roots = components(confirmed(likely, sets, percent))

    # 2. and 3. pairs across components
    for nearest in (True, False):
        rooted = candidates.select("rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("rep", F.coalesce("root", "rep").alias("root"))
        apart = crowded.join(rooted, "rep")
        mixed = apart.groupBy("band").agg(F.count("*").alias("m"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("band", "m")
        rows = (apart.drop("m").join(mixed, "band").withColumn("blocks", F.ceil(F.col("m") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
                .withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
                .withColumn("cell", F.least("block", "with") * F.col("blocks") + F.greatest("block", "with"))
                .select("band", "cell", "rep", "root").join(candidates, "rep").select("band", "cell", "rep", "root", "n", "signature", "fine"))
        cells = rows.repartition(partitions(spark), "band", "cell").sortWithinPartitions("band", "cell")
        pairs = cells.mapInArrow(_cells(least, percent, nearest), "a bigint, b bigint").distinct()
        known = roots.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(confirmed(pairs, sets, percent).unionByName(known))

    # back to the documents
    named = (sketches.select(KEY, "n", "d1", "d2").join(classes, ["n", "d1", "d2"], "left")
             .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .select(KEY, F.col("n").alias("n_shingles"), F.coalesce("root", "rep", KEY).alias("root")))
    return own, distinct, named


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row of docs: documents of similarity percent / 100
    or more are linked; a component is named by its smallest id. Its first document (by key) is kept."""
    own, distinct, named = linked(docs, id_col, text_col, percent, shingle)
    named = named.withColumn("kept", F.expr(f"{KEY} = root"))
    if own is distinct:
        return named.select(F.col(KEY).alias("id"), "n_shingles", F.col("root").alias("component_id"), "kept")
    ids = distinct.select(F.col(KEY).alias("root"), F.col("id").alias("component_id"))
    return own.select(KEY, "id").join(named.join(ids, "root"), KEY).select("id", "n_shingles", "component_id", "kept")
