"""Toxicity with a subsequence string kernel, Nystroem landmarks and a support vector machine.

Words are compared by the gap-weighted subsequence kernel: every three characters in order, with
gaps, spanning at most ``SPAN`` characters, count DECAY**span on either side; the kernel is
normalised by the words' own lengths in that space. An insult with characters put in between
still shares most of its subsequences; punctuation inside a token is dropped and letters spaced
out one by one are joined before comparing.

Training takes a bounded sample of labelled documents outside the held-out fold, cut into
sentences that inherit their document's label. Landmarks are words that set toxic sentences apart
(picked one by one, each unlike those before) and as many everyday words. The Nystroem map
K_mm^-1/2 k(w, landmarks) turns words into vectors for a linear support vector machine. Not every
sentence of a toxic document is toxic: the machine is trained in rounds, with the word of each
toxic sentence that speaks most for the label (and variants of it with a letter put in), and the
words of clean sentences that come closest to the border. A document's score is that of its strongest word, through a logistic curve
fitted on the sample.

Scoring folds the machine into one weight per subsequence of the landmarks, which is exact: the
kernel is a sum over subsequences. So a word costs a few table look-ups.

Defined results: null or empty text has no word and scores as a text of neutral words; rows are
scored one by one, so null and repeated ids do no harm; null labels are not learned, of several
labels of an id the larger counts; without labels of both kinds all scores are 0; an empty
table gives an empty result; labels, lang, source and id never reach a score; other columns are
ignored. Words of more than MAX_WORD bytes are scored in overlapping pieces.
"""

from __future__ import annotations

import gc
import re
from array import array
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kestrel.llm import textscan as ts
from kestrel.llm.common import excerpts, text_id
from kestrel.llm.linear import train_svm

SAMPLE_PER_CLASS = 3000  # labelled documents of either label used for training
TRAIN_CHARS = 8000      # of each of them, spread over the whole text
LANDMARKS = 240
SPAN = 6                 # characters a subsequence of three may span
DECAY = 0.7
COST = 30.0
ROUNDS = 3
LEANING = 2.0            # a word with surely higher odds than that in toxic documents is no example of clean ones
MAX_WORD = 24
INSERTIONS = 1           # variants of every witness with a letter put in, for training
SPACED = 4               # so many single letters in a row are read as one word
CACHE_WORDS = 1 << 20    # margins a Python worker remembers

_SHAPES = [(j, k) for j, k in combinations(range(1, SPAN), 2)]
_WEIGHTS = np.array([DECAY ** (k + 1) for _, k in _SHAPES])
_WIDTH = MAX_WORD + 2    # with a mark at either end
_KEEP = np.zeros(256, dtype=bool)
_KEEP[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_KEEP |= ts.SPACE


def matrix(words: list[bytes]) -> np.ndarray:
    """(words, _WIDTH) uint8: a start mark, the bytes, an end mark, zeros."""
    out = np.zeros((len(words), _WIDTH), dtype=np.uint8)
    for i, w in enumerate(words):
        out[i, :len(w) + 2] = np.frombuffer(b"\x02" + w + b"\x03", dtype=np.uint8)
    return out


def span_matrix(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same for the byte ranges of ``data`` (at most MAX_WORD long)."""
    size = ends - starts
    column = np.arange(MAX_WORD)
    at = np.minimum(starts[:, None] + column, max(len(data) - 1, 0))
    out = np.zeros((len(starts), _WIDTH), dtype=np.uint8)
    out[:, 0] = 2
    out[:, 1:-1] = np.where(column < size[:, None], data[at] if len(data) else 0, 0)
    out[np.arange(len(starts)), size + 1] = 3
    return out


def subsequences(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, weights), a row per word: all gapped triples within SPAN; code 0 fills."""
    width = chars.shape[1]
    wide = np.hstack([chars, np.zeros((len(chars), SPAN), np.uint8)]).astype(np.int32)
    codes = np.empty((len(chars), len(_SHAPES), width), dtype=np.int32)
    first = wide[:, :width] << 16
    for s, (j, k) in enumerate(_SHAPES):
        third = wide[:, k:k + width]
        codes[:, s] = np.where(third > 0, first | wide[:, j:j + width] << 8 | third, 0)
    return codes.reshape(len(chars), -1), np.repeat(_WEIGHTS, width)


def norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Length of each word in the space of subsequences (equal triples add up before squaring)."""
    order = np.argsort(codes, axis=1, kind="stable")
    codes = np.take_along_axis(codes, order, axis=1)
    value = np.where(codes > 0, weights[order], 0.0)
    new = np.ones(codes.shape, dtype=bool)
    new[:, 1:] = codes[:, 1:] != codes[:, :-1]
    sums = np.add.reduceat(value.ravel(), np.flatnonzero(new.ravel()))
    row = np.nonzero(new)[0]
    return np.sqrt(np.bincount(row, weights=sums * sums, minlength=len(codes)))


class Kernel:
    """The kernel against fixed landmark words."""

    def __init__(self, landmarks: list[bytes]):
        self.words = landmarks
        codes, weights = subsequences(matrix(landmarks))
        length = norms(codes, weights)
        self.codes = np.unique(codes[codes > 0])
        self.table = np.zeros((len(self.codes) + 1, len(landmarks)))  # the last row stands for all other triples
        row = np.repeat(np.arange(len(landmarks)), codes.shape[1]).reshape(codes.shape)
        used = codes > 0
        np.add.at(self.table, (np.searchsorted(self.codes, codes[used]), row[used]), np.broadcast_to(weights, codes.shape)[used])
        self.table /= length

    def rows(self, codes: np.ndarray) -> np.ndarray:
        return find(self.codes, codes)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        out = np.empty((len(words), self.table.shape[1]))
        for a in range(0, len(words), 512):
            codes, weights = subsequences(matrix(words[a:a + 512]))
            at = self.rows(codes)
            for i in range(len(codes)):
                hit = at[i] < len(self.codes)
                out[a + i] = weights[hit] @ self.table[at[i][hit]]
            out[a:a + 512] /= np.maximum(norms(codes, weights), 1e-12)[:, None]
        return out


def find(known: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Index in the sorted ``known`` of every code; len(known) for those not there."""
    at = np.searchsorted(known, codes)
    at[at == len(known)] = 0
    return np.where((known[at] == codes) if len(known) else False, at, len(known))


class Machine:
    """What scoring needs: a weight per subsequence, the bias, and the logistic curve."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray, bias: float, curve: tuple[float, float]):
        self.codes, self.weights, self.bias, self.curve = codes, np.append(weights, 0.0), bias, curve

    def margins(self, chars: np.ndarray) -> np.ndarray:
        """Margin of every row of a word matrix; words without a landmark's subsequence have the bias."""
        out = np.full(len(chars), self.bias)
        slots = np.zeros(1 << 16, dtype=bool)  # a coarse sieve before the exact look-up
        slots[_slot(self.codes)] = True
        size = (chars > 0).sum(axis=1)
        order = np.argsort(size, kind="stable")  # words of like length together: little padding
        for a in range(0, len(chars), 4096):
            own = order[a:a + 4096]
            codes, weights = subsequences(chars[own, :int(size[own[-1]])])
            row, col = np.nonzero(slots[_slot(codes)])
            value = np.bincount(row, weights=self.weights[find(self.codes, codes[row, col])] * weights[col], minlength=len(own))
            some = np.flatnonzero(value)
            if len(some):
                out[own[some]] += value[some] / norms(codes[some], weights)
        return out

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.curve[0] * margin + self.curve[1])))


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(16)


# ---------------------------------------------------------------- words of a text

def compact(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slice without anything but letters and white space, A-Z lower-cased."""
    keep = _KEEP[data]
    return ts.LOWER[data[keep]], np.append(0, np.cumsum(keep))[bounds]


def pieces(data: np.ndarray, words: ts.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document) of all words, long ones in overlapping pieces of MAX_WORD bytes."""
    size = words.ends - words.starts
    half = MAX_WORD // 2
    n = np.where(size > MAX_WORD, 1 + -(-(size - MAX_WORD) // half), 1)
    which = np.repeat(np.arange(len(size)), n)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    starts = words.starts[which] + nth * half
    return starts, np.minimum(starts + MAX_WORD, words.ends[which]), words.doc[which]


def spaced_words(data: np.ndarray, words: ts.Words) -> list[tuple[int, bytes]]:
    """(document, letters) of runs of SPACED or more words of one letter each."""
    letters = np.add.reduceat(ts.char_starts(data), words.starts) if len(words.starts) else words.starts
    gap = np.append(words.starts[1:], len(data)) - words.ends if len(words.starts) else words.starts
    # reduceat counts up to the next word's start; the white space between starts code points too
    letters = letters - np.where(np.arange(len(gap)) < len(gap) - 1, gap, len(data) - words.ends if len(gap) else 0)
    single = letters == 1
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.view(np.int8), [0]])))
    out = []
    for a, b in zip(edge[::2], edge[1::2]):
        for doc in np.unique(words.doc[a:b]):
            own = np.arange(a, b)[words.doc[a:b] == doc]
            if len(own) >= SPACED:
                text = b"".join(data[words.starts[i]:words.ends[i]].tobytes() for i in own)
                out += [(int(doc), text[i:i + MAX_WORD]) for i in range(0, max(len(text) - MAX_WORD // 2, 1), MAX_WORD // 2)]
    return out


_SENTENCE = re.compile(rb"[.!?]+(?=\s|$)|\n")


def sentences(text: str) -> list[list[bytes]]:
    """The words of every sentence, as scoring sees them."""
    raw = (text or "").encode()
    data, bounds = compact(np.frombuffer(raw, dtype=np.uint8), np.array([0, *(m.end() for m in _SENTENCE.finditer(raw)), len(raw)]))
    words = ts.Words(data, bounds)
    out: list[list[bytes]] = [[] for _ in bounds[1:]]
    flat = data.tobytes()
    for a, b, d in zip(*(x.tolist() for x in pieces(data, words))):
        out[d].append(flat[a:b])
    for d, word in spaced_words(data, words):
        out[d].append(word)
    return [s for s in out if s]


def with_insertions(words: list[bytes]) -> list[bytes]:
    """Variants of each word of five letters or more, with one letter put in (a fixed choice)."""
    out = []
    for w in words:
        if 5 <= len(w) < MAX_WORD and w.isascii():
            for turn in range(INSERTIONS):
                draw = int(ts.mix(np.array([sum(c * 31 ** i for i, c in enumerate(w)) % (1 << 61) + turn], dtype=np.uint64))[0])
                at = 1 + draw % (len(w) - 1)
                out.append(w[:at] + bytes([97 + (draw >> 20) % 26]) + w[at:])
    return out


# ---------------------------------------------------------------- training

class Sample:
    """Training documents as numbers: words by id, and each document's word ids by sentence."""

    def __init__(self, texts: list[str]):
        ids_of: dict[bytes, int] = {}
        self.ids, self.sentence = [], []
        for text in texts:
            ids, sentence = array("i"), array("i")
            for s, words in enumerate(sentences(text)):
                for w in words:
                    ids.append(ids_of.setdefault(w, len(ids_of)))
                    sentence.append(s)
            self.ids.append(np.array(ids, dtype=np.int32))
            self.sentence.append(np.array(sentence, dtype=np.int32))
        self.words = list(ids_of)
        self.rank = np.empty(len(self.words), dtype=np.int32)  # alphabetical, to break ties
        self.rank[sorted(range(len(self.words)), key=self.words.__getitem__)] = np.arange(len(self.words))

    def counts(self, which: np.ndarray) -> np.ndarray:
        """In how many of the chosen documents each word occurs."""
        out = np.zeros(len(self.words), dtype=np.int64)
        for ids, ok in zip(self.ids, which):
            if ok:
                out[np.unique(ids)] += 1
        return out

    def strengths(self, toxic: np.ndarray) -> np.ndarray:
        """How far a word sets toxic documents apart: by its best substring of four bytes, so that
        the forms of a rare stem add up."""
        part_ids: dict[bytes, int] = {}
        flat, size = array("i"), array("i")
        for w in self.words:
            parts = substrings(w)
            size.append(len(parts))
            flat.extend(part_ids.setdefault(p, len(part_ids)) for p in parts)
        flat, size = np.array(flat, dtype=np.int32), np.array(size, dtype=np.int64)
        start = np.cumsum(size) - size
        counts = np.zeros((2, len(part_ids)))
        for ids, bad in zip(self.ids, toxic):
            own = np.unique(ids)
            n = size[own]
            at = np.repeat(start[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            counts[int(bad), np.unique(flat[at])] += 1
        clean, dirty = counts
        n1, n0 = toxic.sum(), (~toxic).sum()
        odds = (np.log((dirty + 0.5) / (n1 - dirty + 0.5)) - np.log((clean + 0.5) / (n0 - clean + 0.5))) * np.log1p(dirty)
        out = np.zeros(len(self.words))
        np.maximum.at(out, np.repeat(np.arange(len(self.words)), size), odds[flat])
        return out

    def best(self, doc: int, value: np.ndarray, by_sentence: bool) -> np.ndarray:
        """The word of the largest value in the document, or in each of its sentences."""
        ids = self.ids[doc]
        if not len(ids):
            return ids
        sentence = self.sentence[doc] if by_sentence else np.zeros(len(ids), dtype=np.int32)
        order = np.lexsort((self.rank[ids], value[ids], sentence))
        return ids[order][np.append(np.diff(sentence[order]) != 0, True)]


def fit_texts(texts: list[str], toxic: np.ndarray, share: float = 0.5) -> Machine | None:
    """Train on documents and their labels (1 toxic, 0 clean); toxic documents carry ``share`` of the
    weight when the logistic curve is fitted."""
    toxic = np.asarray(toxic) == 1
    if not toxic.any() or toxic.all():
        return None
    sample = Sample(texts)
    words = sample.words
    in_clean, in_toxic = sample.counts(~toxic), sample.counts(toxic)
    strength = sample.strengths(toxic)
    strength[in_toxic == 0] = 0.0
    # a toxic word in a few documents labelled clean (mislabelled, or quoting it) is no clean word
    in_clean[leaning(in_toxic, in_clean, toxic.sum(), (~toxic).sum())] = 0
    frequent = np.lexsort((sample.rank, -in_clean))  # clean words, the most frequent first
    frequent = frequent[:np.count_nonzero(in_clean)]
    kernel = Kernel(choose_landmarks(sample, strength, in_clean, frequent))
    gram = kernel(kernel.words)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors * np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0.0) @ vectors.T  # K_mm^-1/2

    # first witnesses: the strongest word of a toxic document; then the machine's own choice
    bad_docs = np.flatnonzero(toxic)
    strongest = np.unique(np.concatenate([sample.best(d, strength, False) for d in bad_docs]))
    # a substring of one toxic document alone says nothing: a word must share one with another
    alone = (np.log(1.5 / (toxic.sum() - 0.5)) - np.log(0.5 / ((~toxic).sum() + 0.5))) * np.log(2)
    if (strength[strongest] > alone + 1e-9).any():
        strongest = strongest[strength[strongest] > alone + 1e-9]
    negatives = np.concatenate([frequent[:2000], frequent[2000::max(1, (len(frequent) - 2000) // 4000)]])
    as_matrix = matrix(words)
    machine = None
    for _ in range(ROUNDS):
        wanted = {words[i] for i in strongest}
        positives = sorted({*wanted, *with_insertions(sorted(wanted))} - {words[i] for i in frequent})
        others = sorted({words[i] for i in negatives} - set(positives))
        y = np.where(np.arange(len(positives) + len(others)) < len(positives), 1, -1)
        weights = train_svm(kernel(positives + others) @ root, y, cost=COST, passes=10)
        machine = Machine(kernel.codes, kernel.table[:-1] @ (root @ weights[:-1]), float(weights[-1]), (1.0, 0.0))
        margin = machine.margins(as_matrix)
        witnesses = np.concatenate([sample.best(d, margin, True) for d in bad_docs])
        strongest = np.union1d(strongest, witnesses[margin[witnesses] > 0])
        hard = np.lexsort((sample.rank, -np.where(in_clean > 0, margin, -np.inf)))[:min(4000, len(frequent))]
        negatives = np.concatenate([frequent[:1000], hard])
    best = np.array([margin[ids].max(initial=machine.bias) for ids in sample.ids])
    machine.curve = logistic(best, toxic, share)
    return machine


def leaning(in_toxic: np.ndarray, in_clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Words whose odds to be in a toxic document are, beyond chance, LEANING times those to be in a
    clean one or more: the odds ratio less two standard errors."""
    a, b = in_toxic + 0.5, in_clean + 0.5
    c, d = n_toxic - in_toxic + 0.5, n_clean - in_clean + 0.5
    return np.log(a * d / (b * c)) - 2 * np.sqrt(1 / a + 1 / b + 1 / c + 1 / d) > np.log(LEANING)


def substrings(word: bytes) -> set[bytes]:
    """Four-byte substrings of the word with its marks."""
    word = b"\x02" + word + b"\x03"
    return {word[i:i + 4] for i in range(len(word) - 3)}


def choose_landmarks(sample: Sample, strength: np.ndarray, in_clean: np.ndarray, frequent: np.ndarray) -> list[bytes]:
    """Half of the landmarks set toxic texts apart (each unlike those picked before), half are
    everyday words of clean texts, spread over their frequencies."""
    long = np.array([len(w) >= 3 for w in sample.words])
    ranked = [i for i in np.lexsort((sample.rank, -strength))[:20_000] if long[i] and not in_clean[i] and strength[i] > 0][:1500]
    chosen: list[int] = []
    if ranked:
        names = [sample.words[i] for i in ranked]
        gram = Kernel(names)(names)
        left, nearest = strength[ranked].copy(), np.zeros(len(ranked))
        for _ in range(min(LANDMARKS // 2, len(ranked))):
            best = int(np.argmax(left * (1 - nearest)))
            chosen.append(ranked[best])
            nearest = np.maximum(nearest, gram[:, best])
            left[best] = -1.0
    everyday = [i for i in frequent[:8000] if long[i] and i not in set(chosen)][:4000]
    step = max(1, len(everyday) // max(1, LANDMARKS - len(chosen)))
    return [sample.words[i] for i in chosen + everyday[::step][:LANDMARKS - len(chosen)]]


def logistic(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """(slope, offset) of a logistic curve, ``share`` of the weight on label 1; Newton steps,
    slightly damped so that separable data stay finite."""
    weight = np.where(y, share / max(y.sum(), 1), (1 - share) / max((~y).sum(), 1)) * len(y)
    design = np.stack([x, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weight * (y - p)) - 0.05 * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_class: int = SAMPLE_PER_CLASS) -> Machine | None:
    """Train on the ``per_class`` labelled documents of either label whose id hashes are smallest."""
    one = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y in (0, 1)")
           .groupBy("id").agg(F.max("y").alias("y")).filter(text_id("id") != 0).withColumn("rank", F.xxhash64("id")))
    counts = one.agg(F.count("*").alias("n"), F.sum("y").alias("bad")).first()
    picked = one.filter("y = 1").orderBy("rank", "id").limit(per_class).unionByName(one.filter("y = 0").orderBy("rank", "id").limit(per_class))
    texts = docs.select(F.col(id_col).alias("id"), excerpts(F.col(text_col).cast("string"), TRAIN_CHARS).alias("text")).filter("text is not null")
    # one text of every picked id: at most 2 * per_class labels are sent, and as many texts come back
    one_each = texts.join(F.broadcast(picked), "id").groupBy("rank", "id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    got = one_each.select("rank", "id", "text", "y").toArrow()
    got = got.sort_by([("rank", "ascending"), ("id", "ascending"), ("text", "ascending")])
    # the curve weighs toxic documents midway between equal weights and their share of all labels
    share = (counts["bad"] / counts["n"] + 0.5) / 2 if got.num_rows else 0.5
    machine = fit_texts(got["text"].to_pylist(), got["y"].to_numpy(), share) if got.num_rows else None
    del got
    gc.collect()
    pa.default_memory_pool().release_unused()
    return machine


# ---------------------------------------------------------------- scoring

_known: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # per machine: sorted word hashes, their margins


def document_margins(machine: Machine, mark: int, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The largest margin of any word of each document (the bias without words)."""
    out = np.full(len(bounds) - 1, machine.bias)
    data, bounds = compact(data, bounds)
    words = ts.Words(data, bounds)
    starts, ends, doc = pieces(data, words)
    if len(starts):
        hashes = ts.range_hashes(ts.byte_values(data), starts, ends)
        unique, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        known, values = _known.get(mark, (np.empty(0, np.uint64), np.empty(0)))
        place = find(known, unique)
        new = place == len(known)
        margin = np.append(values, 0.0)[place]
        margin[new] = machine.margins(span_matrix(data, starts[at[new]], ends[at[new]]))
        if len(known) + new.sum() > CACHE_WORDS:
            known, values = unique, margin
        else:
            known, values = np.concatenate([known, unique[new]]), np.concatenate([values, margin[new]])
            order = np.argsort(known, kind="stable")
            known, values = known[order], values[order]
        _known.clear()
        _known[mark] = known, values
        np.maximum.at(out, doc, margin[back])
    extra = spaced_words(data, words)
    if extra:
        np.maximum.at(out, np.array([d for d, _ in extra]), machine.margins(matrix([w for _, w in extra])))
    return out


def _scorer(machine: Machine | None, text_col: str, keep: list[str]):
    mark = hash((machine.bias, *machine.curve, len(machine.codes))) if machine else 0

    def run(batches):
        for batch, data, bounds in ts.slices(batches, text_col):
            score = machine.score(document_margins(machine, mark, data, bounds)) if machine else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, pa.array(score)], names=[*keep, "score"])
    return run


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """docs with all columns and ``score``, trained on the labelled rows outside the held-out fold.
    (docs must have no column of that name yet.)"""
    machine = fit(docs, labels, id_col, text_col, label_col)
    return docs.mapInArrow(_scorer(machine, text_col, docs.columns), f"{_ddl(docs)}, score double")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, score) per row of docs, by a machine trained in the same way; texts don't come back."""
    machine = fit(docs, labels, id_col, text_col, label_col)
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_scorer(machine, "text", ["id"]), "id bigint, score double")
