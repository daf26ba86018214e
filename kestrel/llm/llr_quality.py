"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Words and word pairs are hashed into ``BUCKETS`` buckets. Two smoothed multinomials over the
buckets are counted, each over all of its documents: the trusted target (labelled quality 1) and
the raw corpus (every document). A document's score is the sum of log p_target / p_raw over its
n-grams, divided by their number, so that long and short texts compare. Every document is judged
by the same fixed threshold: no random keeping, no quantile of the batch.

The target is smoothed towards the raw multinomial (``toward_raw`` pseudo-counts in all, dealt as
the raw n-grams are): the fewer trusted n-grams there are, the nearer every ratio is to 0, and
documents are not rejected for want of trusted text. Without ``toward_raw`` both multinomials get
SMOOTHING in every bucket, which suits only trusted sets of millions of n-grams.

Beside the score stand the plain rules: too few words, or too many words in repeated 8-word
windows, reject a document whatever its score.

Defined results: null or word-less text has no n-gram, score 0, and fails the base rules; null
and repeated ids are scored row by row; null labels count as unlabelled, an id labelled twice
counts once (trusted if any label says so); without trusted rows every score is 0 and the base
rules decide; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kestrel.llm import textscan as ts
from kestrel.llm.common import KEY, sieved

BUCKETS = 1 << 16
SMOOTHING = 10.0         # added to every bucket's count, in both multinomials
TOWARD_RAW = float(BUCKETS)  # pseudo-counts of the target that are dealt like the raw corpus
THRESHOLD = -0.25        # nats per n-gram
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

SCORED = ("id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "score double, base_failed boolean, kept boolean")


def ngram_buckets(hashes: np.ndarray, words: ts.Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every word and every pair of neighbouring words of one document."""
    mask = np.uint64(BUCKETS - 1)
    pairs = ts.kgrams(hashes, 2)
    inner = words.doc[1:] == words.doc[:-1]
    return (np.concatenate([hashes & mask, pairs[inner] & mask]).astype(np.int64),
            np.concatenate([words.doc, words.doc[:-1][inner]]))


def _counter(batches):
    total = np.zeros(BUCKETS, dtype=np.int64)
    for _, data, bounds in ts.slices(batches, "text"):
        words = ts.Words(data, bounds)
        bucket, _ = ngram_buckets(ts.word_hashes(data, words), words)
        total += np.bincount(bucket, minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """n-gram counts by bucket over all rows of (text): partial counts per task, summed by Spark;
    what reaches the driver is at most BUCKETS rows."""
    rows = texts.select("text").mapInArrow(_counter, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS)
    got = rows.toArrow()
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray, toward_raw: float | None = None) -> np.ndarray:
    """log p_target / p_raw by bucket; zeros where there is no target at all."""
    if not target.sum():
        return np.zeros(BUCKETS)
    if toward_raw is not None:
        # every n-gram scored is in the raw corpus; buckets without any are never looked up
        p_raw = np.maximum(raw, 1) / raw.sum()
        return np.log((target / p_raw + toward_raw) / (target.sum() + toward_raw))
    return np.log((target + SMOOTHING) / (target.sum() + SMOOTHING * BUCKETS)) - np.log((raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS))


def repeats_within(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For keys of documents: (has an equal in its document, is not the first of its equals)."""
    own = keys ^ ts.mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    again = np.zeros(len(own), dtype=bool)
    again[order[1:]] = same
    shared = again.copy()
    shared[order[:-1]] |= same
    return shared, again


def line_repeats(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per document: lines with a word that equal an earlier line of it."""
    n_docs = len(bounds) - 1
    if not len(data):
        return np.zeros(n_docs, dtype=np.int64)
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.union1d(breaks + 1, bounds[:-1])
    starts = starts[starts < len(data)]
    ends = np.minimum(np.append(starts[1:], len(data)), len(data))
    ends = ends - (data[ends - 1] == 0x0A)
    visible = np.append(0, np.cumsum(~ts.SPACE[data]))
    real = visible[ends] > visible[starts]
    starts, ends = starts[real], ends[real]
    doc = np.searchsorted(bounds, starts, side="right") - 1
    _, again = repeats_within(ts.range_hashes(ts.byte_values(data), starts, ends), doc)
    return np.bincount(doc[again], minlength=n_docs)


def words_in_repeats(hashes: np.ndarray, words: ts.Words, width: int = REPEAT_WINDOW) -> np.ndarray:
    """Per document: words inside a ``width``-word window that occurs twice or more in it."""
    n_docs = len(words.first) - 1
    grams = ts.kgrams(hashes, width)
    at = np.flatnonzero(words.doc[:len(grams)] == words.doc[width - 1:]) if len(grams) else np.empty(0, np.int64)
    shared, _ = repeats_within(grams[at], words.doc[at])
    delta = np.zeros(len(hashes) + 1, dtype=np.int32)
    np.add.at(delta, at[shared], 1)
    np.add.at(delta, at[shared] + width, -1)
    return np.bincount(words.doc[np.cumsum(delta[:-1]) > 0], minlength=n_docs)


def _scorer(ratios: np.ndarray, threshold: float):
    def run(batches):
        for batch, data, bounds in ts.slices(batches, "text"):
            n_docs = len(bounds) - 1
            words = ts.Words(data, bounds)
            hashes = ts.word_hashes(data, words)
            n_words = np.diff(words.first)
            visible = np.append(0, np.cumsum(ts.char_starts(data) & ~ts.SPACE[data]))
            symbols = np.append(0, np.cumsum(SYMBOLS[data]))
            in_repeats = words_in_repeats(hashes, words)
            bucket, doc = ngram_buckets(hashes, words)
            score = np.bincount(doc, weights=ratios[bucket], minlength=n_docs) / np.maximum(np.bincount(doc, minlength=n_docs), 1)
            failed = (n_words < MIN_WORDS) | (100 * in_repeats > MAX_REPEAT_PERCENT * n_words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(np.diff(visible[bounds])), pa.array(np.diff(symbols[bounds])),
                 pa.array(line_repeats(data, bounds)), pa.array(in_repeats), pa.array(score), pa.array(failed),
                 pa.array(~failed & (score >= threshold))],
                names=["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept"])
    return run


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
          toward_raw: float | None = None) -> DataFrame:
    """SCORED columns, one row per row of ``docs``. ``labels`` is (id_col, quality)."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    trusted = labels.filter("quality = 1").select(F.col(id_col).cast("bigint").alias(KEY)).distinct()
    # only documents that may be trusted are shuffled to meet the labels; the same way at every size
    likely = sieved(slim.select(F.col("id").alias(KEY), "text"), trusted)[0]
    target = bucket_counts(likely.join(trusted.hint("merge"), KEY, "left_semi"))
    ratios = log_ratios(target, bucket_counts(slim), toward_raw)
    return slim.mapInArrow(_scorer(ratios, threshold), SCORED)
