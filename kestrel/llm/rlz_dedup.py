"""Substring dedup over words by anchored window matching against all earlier text.

The reference of a document is all text of the corpus that comes before it (documents with
smaller keys, and its own beginning). ``repeats`` groups equal windows of ``window`` words by
sampled anchors and their span hashes; a document's spans are its windows that stand in the
reference. Together they are exactly the words covered by a window whose word sequence starts
earlier in the corpus. This replaces a greedy relative Lempel-Ziv parse: a span's source is the
earliest equal group, not the longest match, and no factor is extended word by word.

Defined results: null text counts as empty; documents with fewer words than a window lose
nothing; null or repeated ids are told apart as in ``common.keyed`` (null ids come first);
columns other than id and text are ignored, so clashing names can't arise; an empty table gives
an empty result. Texts may be of any length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kestrel.llm import repeats as rp, textscan as ts
from kestrel.llm.common import keyed

WINDOW_WORDS = 20
ANCHOR_WORDS = 8  # k of the anchors; smaller ones sample more thinly but meet by chance more often

PARSED = "id bigint, kept string, n_words bigint, n_removed bigint, n_factors bigint"


def word_symbols(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = ts.Words(data, bounds)
    return ts.word_hashes(data, words), words.first


def parse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS,
          k: int = ANCHOR_WORDS, single_spaces: bool = True, keep: list[str] = ()) -> DataFrame:
    """(id, kept, n_words, n_removed, n_factors) per row of docs, and the columns ``keep`` of it. ``kept`` holds the words outside
    duplicate spans: joined by one space, or with ``single_spaces=False`` each followed by the white
    space that stood after it. ``n_factors`` counts the spans, touching ones of one source joined."""
    own, distinct = keyed(docs, id_col, text_col, keep)
    spans = rp.repeated_spans(distinct, word_symbols, window, k)
    extra = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) if keep else ""
    return rp.with_spans(own, spans, keep).mapInArrow(_cutter(window, single_spaces), PARSED + extra)


def factors(lists: list[bytes] | None) -> np.ndarray:
    """The document's spans, sorted, touching ones of one source joined."""
    if not lists:
        return np.empty(0, rp.SPAN)
    spans = np.concatenate([np.frombuffer(raw, rp.SPAN) for raw in lists])
    return rp.joined(spans[np.argsort(spans["at"], kind="stable")])


def _cutter(window: int, single_spaces: bool):
    def run(batches):
        for batch, data, bounds in ts.slices(batches, "text"):
            words = ts.Words(data, bounds)
            lists = batch.column(2).to_pylist()
            drop = np.concatenate([rp.covered(x, int(n), window) for x, n in zip(lists, np.diff(words.first))] or [np.empty(0, bool)])
            kept, new_bounds = keep_words(data, bounds, words, ~drop, single_spaces)
            texts = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(new_bounds.astype(np.int64)), pa.py_buffer(kept))
            dropped = np.append(0, np.cumsum(drop))[words.first]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), texts.cast(pa.string()), pa.array(np.diff(words.first)), pa.array(np.diff(dropped)),
                 pa.array([len(factors(x)) for x in lists], pa.int64()), *batch.columns[3:]],
                names=["id", "kept", "n_words", "n_removed", "n_factors", *batch.schema.names[3:]])
    return run


def keep_words(data: np.ndarray, bounds: np.ndarray, words: ts.Words, keep: np.ndarray, single_spaces: bool) -> tuple[bytes, np.ndarray]:
    """(bytes, new document bounds) of the kept words."""
    data = data.copy()
    delta = np.zeros(len(data) + 1, dtype=np.int8)
    if single_spaces:
        # a kept word, and before it one separator unless it is its document's first kept word
        kept = np.flatnonzero(keep)
        inner = np.append(False, words.doc[kept][1:] == words.doc[kept][:-1]) if len(kept) else np.empty(0, bool)
        begin, end = words.starts[kept] - inner, words.ends[kept]
        data[begin[inner]] = 0x20
    else:
        # a kept word with what follows it, up to the next word; white space before the first word stays
        following = np.append(words.starts[1:], len(data)) if len(words.starts) else words.starts
        last = np.append(words.doc[1:] != words.doc[:-1], True) if len(words.starts) else np.empty(0, bool)
        following = np.where(last, bounds[words.doc + 1], following) if len(words.starts) else following
        begin, end = words.starts[keep], following[keep]
        lead_end = np.append(words.starts, len(data))[np.minimum(words.first[:-1], len(words.starts))]
        lead_end = np.where(np.diff(words.first) > 0, lead_end, bounds[1:])
        np.add.at(delta, bounds[:-1], 1)
        np.add.at(delta, lead_end, -1)
    np.add.at(delta, begin, 1)
    np.add.at(delta, end, -1)
    mask = np.cumsum(delta[:-1], dtype=np.int8) > 0
    return data[mask].tobytes(), np.append(0, np.cumsum(mask))[bounds]
