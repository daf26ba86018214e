"""Exact search for windows that occur earlier, over any sequence of symbols (bytes or words).

A window is W consecutive symbols of one document. A window *repeats* if an equal one starts
earlier: in a document with a smaller key, or earlier in its own. Finding every repeated window
without a row per window:

1. *Anchors.* In each window the leftmost k-gram with the smallest hash is its anchor. Equal
   windows have equal anchors at equal offsets, and neighbouring windows mostly share one, so
   the windows of a document fall into groups, about 2 / (W - k + 2) per symbol. Of a group
   only two hashes travel: of its anchor, and of all symbols its windows span.
2. *Settling.* Groups with the same anchor and span hash hold the same windows, one by one: in
   all but the earliest of them every window repeats. If an anchor has several span hashes, the
   earliest group of each may still share some windows with the others (the ends of a copied
   passage): those are *open*.
3. *Edges.* Only open groups are looked at window by window: the windows of one anchor meet in
   one task, or spread by their own hashes where an anchor has very many open groups.

Hot keys: a task keeps the earliest group of each (anchor, span) it meets and decides the others
itself, so a passage that a third of all documents share sends at most one row per task and
flush. Decisions rest on two independent hashes modulo 2**61 - 1 of the whole span or window,
beside its anchor's: 10**7 different spans of one anchor make 5 * 10**13 pairs against 2**121.

What travels is packed: per task and target partition one row with a few numpy arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kestrel.llm import textscan as ts
from kestrel.llm.common import KEY, partitions, sieved, stored

FLUSH_GROUPS = 1 << 20  # groups a task holds before it sends them off (40 bytes each, a few copies)

#: A span of window starts: from ``at``, ``n`` of them; an equal run starts at ``src_at`` of ``src``.
SPAN = np.dtype([("at", "<i4"), ("n", "<i4"), ("src", "<i8"), ("src_at", "<i4")])
#: One of the groups: what it is known by, and where it is.
GROUP = np.dtype([("anchor", "<u8"), ("span", "<u8"), ("check", "<u8"), ("key", "<i8"), ("at", "<i4"), ("n", "<i4")])
#: Columns of packed groups and the fields they hold.
FIELDS = {"anchor": "anchor", "span": "span", "check": "check", "keys": "key", "at": "at", "n": "n"}

PACKED = "part int, key bigint, spans binary, anchor binary, span binary, check binary, keys binary, at binary, n binary"
SETTLED = f"{KEY} bigint, kind int, spans binary"
#: Kinds of SETTLED rows: spans that repeat, open spans, and open spans of an anchor with more than CROWD of them.
REPEATED, OPEN, CROWDED = 0, 1, 2
CROWD = 1024
PACKED_SPANS = "part int, keys binary, at binary, n binary, anchor binary, symbols binary"

#: (data, bounds) of a slice -> (symbols as uint64, first symbol of each document)
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def packed_column(values: np.ndarray) -> bytes:
    """The values byte by byte (all lowest bytes first): what is zero or alike then stands together
    and the shuffle's compression removes it."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def unpacked_column(raw, n: int, dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, n).T).view(dtype).ravel() if n else np.empty(0, dtype)


def groups_of(values: np.ndarray, first: np.ndarray, keys: np.ndarray, window: int, k: int) -> np.ndarray:
    """GROUP rows of a slice: ``values`` are its symbols, ``first`` bounds its documents."""
    count = np.maximum(np.diff(first) - window + 1, 0)
    starts = np.repeat(first[:-1], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    if not len(starts):
        return np.empty(0, GROUP)
    grams = ts.kgrams(values, k)
    anchor = ts.leftmost_minima(grams, window - k + 1)[starts]
    doc = np.repeat(np.arange(len(count)), count)
    new = np.empty(len(starts), dtype=bool)
    new[0] = True
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(starts)))
    begin = starts[head]
    out = np.empty(len(head), GROUP)
    out["anchor"] = grams[anchor[head]]
    # the anchor's place within the span belongs to what must be equal
    out["span"] = ts.mix(ts.range_hashes(values, begin, begin + n + window - 1) + (anchor[head] - begin).astype(np.uint64))
    out["check"] = ts.range_hashes(values, begin, begin + n + window - 1, base=1)
    out["key"] = keys[doc[head]]
    out["at"] = begin - first[doc[head]]
    out["n"] = n
    return out


def in_order(groups: np.ndarray) -> np.ndarray:
    """Order by what groups are known by, then by place."""
    return np.lexsort((groups["at"], groups["key"], groups["check"], groups["span"], groups["anchor"]))


def leads(groups: np.ndarray) -> np.ndarray:
    """Which of the ordered groups are the first of their kind."""
    out = np.zeros(len(groups), dtype=bool)
    out[:1] = True
    for field in ("anchor", "span", "check"):
        out[1:] |= groups[field][1:] != groups[field][:-1]
    return out


def settle(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(groups in order, which are the earliest of their kind, index of that earliest one)."""
    groups = groups[in_order(groups)]
    lead = leads(groups)
    return groups, lead, np.maximum.accumulate(np.where(lead, np.arange(len(groups)), 0))


def spans_by_key(groups: np.ndarray, source: np.ndarray | None, plain: bool = False) -> Iterator[tuple[int, bytes]]:
    """(key, SPAN array as bytes) of the given groups, neighbours with the same source joined;
    ``plain``: all neighbours, sources are of no interest."""
    if not len(groups):
        return
    spans = np.zeros(len(groups), SPAN)
    spans["at"], spans["n"] = groups["at"], groups["n"]
    if plain:
        spans["src_at"] = spans["at"]
    elif source is not None:
        spans["src"], spans["src_at"] = source["key"], source["at"]
    order = np.lexsort((groups["at"], groups["key"]))
    keys, spans = groups["key"][order], spans[order]
    cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    for a, b in zip(cut, np.append(cut[1:], len(keys))):
        yield int(keys[a]), joined(spans[a:b]).tobytes()


def joined(spans: np.ndarray) -> np.ndarray:
    """Sorted spans with touching ones of the same source (at the same distance) made one."""
    if len(spans) < 2:
        return spans
    end = spans["at"][:-1] + spans["n"][:-1]
    same = (end == spans["at"][1:]) & (spans["src"][1:] == spans["src"][:-1]) \
        & (spans["src_at"][1:] - spans["at"][1:] == spans["src_at"][:-1] - spans["at"][:-1])
    cut = np.flatnonzero(np.append(True, ~same))
    out = spans[cut].copy()
    out["n"] = np.add.reduceat(spans["n"], cut)
    return out


def _packed(groups: np.ndarray, parts: int, plain: bool = False) -> Iterator[pa.RecordBatch]:
    """Settle what one task holds: its repeats leave as spans per document, the earliest groups as
    one packed row per target partition."""
    groups, lead, source = settle(groups)
    later = ~lead
    rows = {name: [] for name in ("part", "key", "spans", *FIELDS)}

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["part"], pa.int32()), pa.array(rows["key"], pa.int64())]
            + [pa.array(rows[c], pa.binary()) for c in ("spans", *FIELDS)], names=list(rows))

    for key, spans in spans_by_key(groups[later], groups[source[later]], plain):
        rows["part"].append(key % parts)
        rows["key"].append(key)
        rows["spans"].append(spans)
    nothing = [None] * len(rows["part"])
    for c in FIELDS:
        rows[c] += nothing
    if nothing:
        yield batch()
    groups = groups[lead]
    part = (groups["anchor"] % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    groups, part = groups[order], part[order]
    cut = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    rows = {name: [] for name in rows}
    for a, b in zip(cut, np.append(cut[1:], len(part))):
        rows["part"].append(int(part[a]))
        rows["key"].append(None)
        rows["spans"].append(None)
        for c, f in FIELDS.items():
            rows[c].append(packed_column(groups[f][a:b]))
    if rows["part"]:
        yield batch()


def packer(symbols: Symbols, window: int, k: int, parts: int, plain: bool = False):
    """mapInArrow body: documents (KEY, text) -> packed groups."""
    def run(batches):
        held, size = [], 0
        for batch, data, bounds in ts.slices(batches, "text"):
            values, first = symbols(data, bounds)
            found = groups_of(values, first, batch.column(0).to_numpy(zero_copy_only=False), window, k)
            held.append(found)
            size += len(found)
            if size >= FLUSH_GROUPS:
                yield from _packed(np.concatenate(held), parts, plain)
                held, size = [], 0
        if size:
            yield from _packed(np.concatenate(held), parts, plain)
    return run


def window_packer(symbols: Symbols, window: int, parts: int):
    """mapInArrow body: documents (KEY, text, spans list) with open spans -> one packed group per
    window of those spans, known by two hashes of the window."""
    def run(batches):
        held, size = [], 0
        for batch, data, bounds in ts.slices(batches, "text"):
            values, first = symbols(data, bounds)
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            at, doc = [], []
            for d, lists in enumerate(batch.column(2).to_pylist()):
                spans = np.concatenate([np.frombuffer(raw, SPAN) for raw in lists])
                mine = np.unique(np.concatenate([np.arange(a, a + n) for a, n in zip(spans["at"], spans["n"])]))
                at.append(mine)
                doc.append(np.full(len(mine), d))
            at, doc = np.concatenate(at), np.concatenate(doc)
            found = np.empty(len(at), GROUP)
            begin = first[doc] + at
            found["anchor"] = ts.range_hashes(values, begin, begin + window)
            found["span"] = 0
            found["check"] = ts.range_hashes(values, begin, begin + window, base=1)
            found["key"], found["at"], found["n"] = keys[doc], at, 1
            held.append(found)
            size += len(found)
            if size >= FLUSH_GROUPS:
                yield from _packed(np.concatenate(held), parts)
                held, size = [], 0
        if size:
            yield from _packed(np.concatenate(held), parts)
    return run


def unpack(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, list[tuple[int, bytes]]]:
    """All groups of a partition, and the spans already settled by the sending tasks."""
    held, passed = [], []
    for batch in batches:
        cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            if cols["key"][i].is_valid:
                passed.append((cols["key"][i].as_py(), cols["spans"][i].as_py()))
                continue
            n = cols["n"][i].as_buffer().size // 4
            out = np.empty(n, GROUP)
            for c, f in FIELDS.items():
                out[f] = unpacked_column(cols[c][i].as_py(), n, GROUP[f])
            held.append(out)
    return np.concatenate(held) if held else np.empty(0, GROUP), passed


def settled_batches(rows: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 20_000):
        keys, kinds, spans = zip(*rows[i:i + 20_000])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(kinds, pa.int32()), pa.array(spans, pa.binary())],
                                         names=[KEY, "kind", "spans"])


def open_rows(leaders: np.ndarray, which: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[int, int, bytes]]:
    """Rows for the earliest groups (sorted by anchor) whose anchor has several; ``which`` narrows
    that down to some of the anchors, given the run each leader belongs to."""
    if not len(leaders):
        return
    run = np.append(0, np.cumsum(leaders["anchor"][1:] != leaders["anchor"][:-1]))
    size = np.bincount(run)
    wanted = size > 1 if which is None else (size > 1) & which(run)
    for kind, fits in ((OPEN, size <= CROWD), (CROWDED, size > CROWD)):
        for key, spans in spans_by_key(leaders[(wanted & fits)[run]], None):
            yield key, kind, spans


def settler(with_open: bool):
    """mapInArrow body: packed groups of one partition (all groups of an anchor are here) ->
    SETTLED rows: repeated spans, and with ``with_open`` the spans still to be looked at."""
    def run(batches):
        groups, passed = unpack(batches)
        groups, lead, source = settle(groups)
        later = ~lead
        rows = [(key, REPEATED, spans) for key, spans in passed]
        rows += [(key, REPEATED, spans) for key, spans in spans_by_key(groups[later], groups[source[later]])]
        if with_open:
            rows += open_rows(groups[lead])
        yield from settled_batches(rows)
        del groups, rows
        ts.give_back()
    return run


# ---- edges by span: the symbols of an open span travel once, not a hash for each of its windows

def span_packer(symbols: Symbols, window: int, k: int, parts: int):
    """mapInArrow body: documents (KEY, text, spans list) with open spans -> PACKED_SPANS: the bytes
    of every open span, dealt by anchor. Only for symbols that are single bytes."""
    def run(batches):
        held, texts, size = [], [], 0
        for batch, data, bounds in ts.slices(batches, "text"):
            values, first = symbols(data, bounds)
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            groups = groups_of(values, first, np.arange(len(keys)), window, k)
            lists = batch.column(2).to_pylist()
            spans = [np.unique(np.concatenate([np.frombuffer(raw, SPAN)["at"] for raw in x])) for x in lists]
            wanted = np.concatenate([d << 32 | at.astype(np.int64) for d, at in enumerate(spans)])
            groups = groups[np.isin(groups["key"] << 32 | groups["at"], wanted)]
            begin = first[groups["key"]] + groups["at"]
            length = groups["n"] + window - 1
            where = np.repeat(begin, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            groups["key"] = keys[groups["key"]]
            held.append(groups)
            texts.append(data[where])
            size += len(where)
            if size >= 8 * FLUSH_GROUPS:
                yield from _packed_spans(np.concatenate(held), np.concatenate(texts), window, parts)
                held, texts, size = [], [], 0
        if held:
            yield from _packed_spans(np.concatenate(held), np.concatenate(texts), window, parts)
    return run


def _packed_spans(groups: np.ndarray, text: np.ndarray, window: int, parts: int) -> Iterator[pa.RecordBatch]:
    length = groups["n"] + window - 1
    offset = np.append(0, np.cumsum(length, dtype=np.int64))
    part = (groups["anchor"] % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1])) if len(part) else []
    rows = {name: [] for name in ("part", "keys", "at", "n", "anchor", "symbols")}
    for a, b in zip(cut, np.append(cut[1:], len(part))):
        own = order[a:b]
        rows["part"].append(int(part[own[0]]))
        for c, f in (("keys", "key"), ("at", "at"), ("n", "n"), ("anchor", "anchor")):
            rows[c].append(packed_column(groups[f][own]))
        rows["symbols"].append(b"".join(text[offset[i]:offset[i + 1]].tobytes() for i in own))
    if rows["part"]:
        yield pa.RecordBatch.from_arrays([pa.array(rows["part"], pa.int32())] + [pa.array(rows[c], pa.binary()) for c in list(rows)[1:]], names=list(rows))


def span_settler(window: int):
    """mapInArrow body: PACKED_SPANS of one partition -> SETTLED rows of the windows that repeat.
    Anchors are taken in runs of at most 4 * CROWD spans (an anchor has few more than CROWD)."""
    def run(batches):
        held, texts = [], []
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["at"]) // 4
                out = np.empty(n, GROUP)
                for c, f in (("keys", "key"), ("at", "at"), ("n", "n"), ("anchor", "anchor")):
                    out[f] = unpacked_column(row[c], n, GROUP[f])
                held.append(out)
                texts.append(np.frombuffer(row["symbols"], np.uint8))
        if not held:
            return
        groups, text = np.concatenate(held), np.concatenate(texts)
        offset = np.append(0, np.cumsum(groups["n"] + window - 1, dtype=np.int64))
        order = np.argsort(groups["anchor"], kind="stable")
        anchors = groups["anchor"][order]
        cut = np.append(np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1])), len(order))
        start = 0
        while start < len(cut) - 1:
            stop = max(int(np.searchsorted(cut, cut[start] + 4 * CROWD, side="right")) - 1, start + 1)
            yield from settled_batches(_settled_windows(groups, text, offset, order[cut[start]:cut[stop]], window))
            start = stop
    return run


def _settled_windows(groups, text, offset, own, window) -> list[tuple[int, int, bytes]]:
    length = groups["n"][own] + window - 1
    where = np.repeat(offset[own], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    values = ts.byte_values(text[where])
    n = groups["n"][own]
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(np.cumsum(length) - length, n) + nth
    out = np.empty(len(nth), GROUP)
    out["anchor"] = ts.range_hashes(values, begin, begin + window)
    out["span"] = 0
    out["check"] = ts.range_hashes(values, begin, begin + window, base=1)
    out["key"], out["at"], out["n"] = np.repeat(groups["key"][own], n), np.repeat(groups["at"][own], n) + nth, 1
    out, lead, _ = settle(out)
    return [(key, REPEATED, spans) for key, spans in spans_by_key(out[~lead], None, plain=True)]


def by_part(packed: DataFrame, parts: int) -> DataFrame:
    return packed.repartitionById(parts, F.col("part"))


def repeated_spans(docs: DataFrame, symbols: Symbols, window: int, k: int) -> DataFrame:
    """(KEY, spans list<binary SPAN>) of every document with repeated windows. ``docs`` is (KEY, text)."""
    parts = partitions(docs.sparkSession)
    packed = docs.select(KEY, "text").mapInArrow(packer(symbols, window, k, parts), PACKED)
    found = stored(by_part(packed, parts).mapInArrow(settler(True), SETTLED))
    edges = windows_of(docs, found.filter(F.col("kind") != REPEATED), symbols, window, parts)
    return spans_list(found.filter(F.col("kind") == REPEATED).unionByName(edges))


def windows_of(docs: DataFrame, found: DataFrame, symbols: Symbols, window: int, parts: int) -> DataFrame:
    """SETTLED rows of the windows in the open spans ``found`` that repeat, each window by itself."""
    some = sieved(docs.select(KEY, "text"), found)[0].join(spans_list(found), KEY)
    return by_part(some.mapInArrow(window_packer(symbols, window, parts), PACKED), parts).mapInArrow(settler(False), SETTLED)


def edges_of(docs: DataFrame, found: DataFrame, symbols: Symbols, window: int, k: int, parts: int) -> DataFrame:
    """The same for byte symbols: span by span where an anchor has few, window by window elsewhere."""
    few, many = (found.filter(F.col("kind") == kind) for kind in (OPEN, CROWDED))
    some = sieved(docs.select(KEY, "text"), few)[0].join(spans_list(few), KEY)
    by_span = by_part(some.mapInArrow(span_packer(symbols, window, k, parts), PACKED_SPANS), parts).mapInArrow(span_settler(window), SETTLED)
    return by_span.unionByName(windows_of(docs, many, symbols, window, parts))


def spans_list(found: DataFrame) -> DataFrame:
    """One row per document; its spans come in pieces bounded by the document's own length."""
    return found.groupBy(KEY).agg(F.collect_list("spans").alias("spans"))


def with_spans(own: DataFrame, spans: DataFrame, keep: list[str] = ()) -> DataFrame:
    """(id, text, spans, and the columns ``keep``) of every row: only documents that may have spans are shuffled to meet them."""
    spans = stored(spans)
    some, none = sieved(own, spans)
    return some.join(spans, KEY, "left").select("id", "text", "spans", *keep).unionByName(
        none.select("id", "text", F.lit(None).cast("array<binary>").alias("spans"), *keep))


def covered(lists: list[bytes] | None, n: int, window: int) -> np.ndarray:
    """Boolean per symbol of a document with n symbols: inside a repeated window."""
    out = np.zeros(n, dtype=bool)
    if lists:
        spans = np.concatenate([np.frombuffer(raw, SPAN) for raw in lists])
        delta = np.zeros(n + 1, dtype=np.int32)
        np.add.at(delta, spans["at"], 1)
        np.add.at(delta, spans["at"] + spans["n"] + window - 1, -1)
        out = np.cumsum(delta[:-1]) > 0
    return out
