"""Substring dedup with a logarithmic family of suffix indexes, over UTF-8 bytes.

The corpus comes in batches of ascending keys. A batch gets a suffix array: its anchor suffixes
(see ``repeats``: the positions where a 100-byte window has its smallest 32-gram), sorted by the
hash of their first 32 bytes, then of all bytes their windows span, then by place. It is kept in
hash ranges, a range in rows of at most LEVEL_ROW suffixes. The array is merge-scanned against every existing
level, range by range: equal neighbours in the merged order are long matches, and the later one
is a duplicate. Level i holds the arrays of 2**i batches. A new batch takes the first empty
level and merges the full ones below it into itself on the way (as a binary counter carries),
in the very task that scans them, so every suffix is rewritten at most log2(batches) times.
An index keeps only the earliest suffix of each kind; later ones could never be a first place.

Sampling loses nothing: equal windows have equal anchors, and where two suffixes agree in the
anchor but not in the whole span their windows are compared one by one.

Defined results: null text is empty; documents shorter than a window lose nothing; null or
repeated ids are told apart as in ``common.keyed``; other columns are ignored; an empty table
gives an empty result. Removal works on bytes, so what is kept may cut a character in two: it is
returned as binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kestrel.llm import repeats as rp, textscan as ts
from kestrel.llm.common import KEY, keyed, partitions, stored

WINDOW_BYTES = 100
ANCHOR_BYTES = 32
BATCHES = 3

CUT = "id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"
#: A scan's rows: settled spans (key set), or the arrays of one hash range of the new level (part set).
ARRAYS = tuple(rp.FIELDS)
SCANNED = f"part int, {rp.SETTLED}, " + ", ".join(f"{c} binary" for c in ARRAYS)
LEVEL_ROW = 1 << 20  # suffixes in one row of a level: no cell grows with the corpus


def byte_symbols(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ts.byte_values(data), bounds


class SuffixIndex:
    """The levels, and what has been found so far. ``add`` takes batches in ascending key order."""

    def __init__(self, spark, window: int = WINDOW_BYTES, k: int = ANCHOR_BYTES):
        self.window, self.k, self.parts = window, k, partitions(spark)
        self.levels: list[DataFrame | None] = []
        self.found: list[DataFrame] = []

    def add(self, docs: DataFrame, last: bool = False) -> None:
        """Index (KEY, text) and look its windows up in all levels; ``last``: no further batch will
        come, so no new level is written."""
        full = next((i for i, level in enumerate(self.levels) if level is None), len(self.levels))
        carried = self.levels[:full]  # these merge with the batch into level ``full``
        packed = docs.select(KEY, "text").mapInArrow(rp.packer(byte_symbols, self.window, self.k, self.parts, plain=True), rp.PACKED)
        packed = packed.withColumn("level", F.lit(-1))
        for i, level in enumerate(self.levels):
            if level is not None:
                packed = packed.unionByName(level.select("part", *ARRAYS, F.lit(i).alias("level")), allowMissingColumns=True)
        scanned = stored(rp.by_part(packed, self.parts).mapInArrow(_merge_scan(full, not last), SCANNED))
        self.found.append(scanned.filter(f"{KEY} is not null").select(KEY, "kind", "spans"))
        if not last:
            self.levels = [None] * len(carried) + [scanned.filter("part is not null")] + self.levels[full + 1:]

    def spans(self, docs: DataFrame) -> DataFrame:
        """(KEY, spans) of every indexed document with repeated windows."""
        found = self.found[0]
        for more in self.found[1:]:
            found = found.unionByName(more)
        edges = rp.edges_of(docs, found, byte_symbols, self.window, self.k, self.parts)
        return rp.spans_list(found.filter(F.col("kind") == rp.REPEATED).unionByName(edges))


def _merge_scan(full: int, keep: bool):
    """mapInArrow body over one hash range: the batch's packed groups (level -1) and the arrays of
    the existing levels -> spans settled, and with ``keep`` the arrays of the new level."""
    def run(batches):
        batches = list(batches)
        groups, level, passed = [], [], []
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                got, sent = rp.unpack([one])
                passed += sent
                groups.append(got)
                level.append(np.full(len(got), one.column(one.schema.get_field_index("level"))[0].as_py(), np.int8))
        groups = np.concatenate(groups) if groups else np.empty(0, rp.GROUP)
        level = np.concatenate(level) if level else np.empty(0, np.int8)
        order = rp.in_order(groups)
        groups, level = groups[order], level[order]
        lead = rp.leads(groups)
        later = ~lead  # always of the batch: a level's groups are the earliest of their kind
        rows = [(key, rp.REPEATED, spans) for key, spans in passed]
        rows += [(key, rp.REPEATED, spans) for key, spans in rp.spans_by_key(groups[later], None, plain=True)]
        leaders, own = groups[lead], level[lead] < 0
        # an anchor with several spans, one of them of this batch: its earliest groups are open
        rows += rp.open_rows(leaders, lambda run: np.bincount(run, weights=own) > 0)
        for batch in rp.settled_batches(rows):
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()), *batch.columns, *[pa.nulls(n, pa.binary()) for _ in ARRAYS]],
                                             names=["part", KEY, "kind", "spans", *ARRAYS])
        if keep and batches and len(leaders):
            merged = leaders[level[lead] < full]
            part = next(b.column(b.schema.get_field_index("part"))[0].as_py() for b in batches if b.num_rows)
            for i in range(0, len(merged), LEVEL_ROW):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
                     *[pa.array([rp.packed_column(merged[f][i:i + LEVEL_ROW])], pa.binary()) for f in rp.FIELDS.values()]],
                    names=["part", KEY, "kind", "spans", *ARRAYS])
    return run


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_BYTES,
           k: int = ANCHOR_BYTES, batches: int = BATCHES) -> DataFrame:
    """(id, kept binary, n_bytes, n_removed, n_spans) per row of docs: each byte covered by a
    ``window``-byte string that starts earlier too is removed. Batches are key ranges of about
    equal size; their number changes the work, never the result."""
    own, distinct = keyed(docs, id_col, text_col)
    cuts = distinct.agg(F.percentile_approx(KEY, [i / batches for i in range(1, batches)]).alias("cuts")).first()["cuts"] if batches > 1 else []
    edges = [None, *sorted(set(cuts or [])), None]
    index = SuffixIndex(docs.sparkSession, window, k)
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        batch = distinct
        if low is not None:
            batch = batch.filter(F.col(KEY) > low)
        if high is not None:
            batch = batch.filter(F.col(KEY) <= high)
        index.add(batch, last=i == len(edges) - 2)
    return rp.with_spans(own, index.spans(distinct)).mapInArrow(_cutter(window), CUT)


def _cutter(window: int):
    def run(batches):
        for batch, data, bounds in ts.slices(batches, "text"):
            size = np.diff(bounds)
            drop = np.concatenate([rp.covered(x, int(n), window) for x, n in zip(batch.column(2).to_pylist(), size)] or [np.empty(0, bool)])
            before = np.append(0, np.cumsum(drop))[bounds]
            begins = drop.copy()
            begins[1:] &= ~drop[:-1]
            inner = bounds[:-1][size > 0]
            begins[inner] = drop[inner]  # a run never crosses documents
            kept_bounds = bounds - before
            kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(kept_bounds.astype(np.int64)), pa.py_buffer(data[~drop].tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), kept.cast(pa.binary()), pa.array(size), pa.array(np.diff(before)),
                 pa.array(np.diff(np.append(0, np.cumsum(begins))[bounds]))],
                names=["id", "kept", "n_bytes", "n_removed", "n_spans"])
    return run
