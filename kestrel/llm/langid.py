"""Language identification by hierarchical discrimination.

A text's features are its hashed byte n-grams (1 to 3 bytes, A-Z lower-cased, runs of anything
that is no letter counted as one space), square-rooted counts scaled to unit length. The first level
predicts the language family with one-versus-rest linear support vector machines; within the
family, one-versus-one linear support vector machines separate each pair of languages and vote
(ties go to the larger sum of margins). Each machine is trained by dual coordinate descent on a
bounded sample: at most ``SAMPLE_PER_LANGUAGE`` documents of each language, those with the
smallest hash of their id, and ``TRAIN_CHARS`` characters of each, spread over its whole text. Predictions read whole texts.

Defined results: null text, or text without letters, is `und` with score 0. Rows are predicted
one by one, so repeated and null ids do no harm. Nulls and blanks in ``lang`` are not learned. With no language
to learn every prediction is `und`; with one, that one. Ties in a vote and a margin go to the
language first in the alphabet. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from kestrel.llm import textscan as ts
from kestrel.llm.common import excerpts, text_id
from kestrel.llm.linear import train_svm

UNKNOWN = "und"
BUCKETS = 1 << 13
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 600   # training documents of a language
TRAIN_CHARS = 4000          # of each training document, spread over its whole text

#: Families of the languages with two-letter codes most often met. A language that
#: is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nl nn no nb sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa si ur",
    "semitic": "am ar he mt",
    "celtic": "br cy ga gd",
    "baltic": "lt lv",
    "austronesian": "id jv ms su tl",
    "dravidian": "kn ml ta te",
}

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def family_of(lang: str) -> str:
    base = lang.lower().split("-")[0].split("_")[0]
    return next((name for name, members in FAMILIES.items() if base in members.split()), lang)


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(documents, BUCKETS) float32, rows of unit length; a row without letters is zero.

    Bytes beyond ASCII count as letters here: they are part of one in every script."""
    n_docs = len(bounds) - 1
    out = np.zeros((n_docs, BUCKETS), dtype=np.float32)
    letter = _LETTER[data]
    keep = letter.copy()
    keep[:-1] |= letter[1:]     # a letter, or the one gap byte just before a letter
    keep[bounds[:-1][bounds[:-1] < len(data)]] = letter[bounds[:-1][bounds[:-1] < len(data)]]
    values = np.where(letter, ts.LOWER[data], 0x20)[keep].astype(np.uint64)
    at = np.append(0, np.cumsum(keep))[bounds]
    doc = np.repeat(np.arange(n_docs), np.diff(at))
    code = np.zeros(len(values), dtype=np.uint64)
    for order in range(1, max(ORDERS) + 1):
        m = len(values) - order + 1
        if m <= 0:
            break
        code = code[:m] * np.uint64(256) + values[order - 1:]
        if order in ORDERS:
            inner = doc[:m] == doc[order - 1:]
            bucket = (ts.mix(code + np.uint64(order << 56)) % np.uint64(BUCKETS)).astype(np.int64)
            flat = np.bincount(doc[:m][inner] * BUCKETS + bucket[inner], minlength=n_docs * BUCKETS)
            out += flat.reshape(n_docs, BUCKETS)
    np.sqrt(out, out=out)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(norm > 0, norm, 1)


class Model:
    """Families in order, their one-versus-rest weights, and the pair machines inside each."""

    def __init__(self, langs: list[str], x: np.ndarray, y: np.ndarray):
        self.langs = langs
        self.families = sorted({family_of(lang) for lang in langs})
        family = np.array([self.families.index(family_of(lang)) for lang in langs], dtype=int)
        self.members = [[i for i in range(len(langs)) if family[i] == f] for f in range(len(self.families))]
        columns = []
        if len(self.families) > 1:
            of = family[y]
            columns = [train_svm(x, np.where(of == f, 1, -1)) for f in range(len(self.families))]
        self.pairs = []
        for members in self.members:
            for a, b in combinations(members, 2):
                rows = (y == a) | (y == b)
                self.pairs.append((a, b))
                columns.append(train_svm(x[rows], np.where(y[rows] == a, 1, -1)))
        self.weights = np.array(columns, dtype=np.float32).T if columns else np.zeros((BUCKETS + 1, 0), np.float32)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, score between 0 and 1) of every row."""
        margins = (x @ self.weights[:-1] + self.weights[-1]).astype(np.float64)
        n, n_fam = len(x), len(self.families)
        family, sure = np.zeros(n, dtype=int), np.ones(n)
        offset = 0
        if n_fam > 1:
            family = margins[:, :n_fam].argmax(axis=1)
            sure = 1 / (1 + np.exp(-2 * margins[np.arange(n), family]))
            offset = n_fam
        votes, total = np.zeros((n, len(self.langs))), np.zeros((n, len(self.langs)))
        for j, (a, b) in enumerate(self.pairs):
            margin = margins[:, offset + j]
            votes[:, a] += margin >= 0
            votes[:, b] += margin < 0
            total[:, a] += margin
            total[:, b] -= margin
        allowed = np.zeros((n_fam, len(self.langs)), dtype=bool)
        for f, members in enumerate(self.members):
            allowed[f, members] = True
        rank = np.where(allowed[family], votes + 0.5 * np.tanh(total) / max(len(self.langs), 1), -np.inf)
        lang = rank.argmax(axis=1)
        size = allowed[family].sum(axis=1)
        pair_sure = np.where(size > 1, 1 / (1 + np.exp(-2 * total[np.arange(n), lang] / np.maximum(size - 1, 1))), 1.0)
        return lang, sure * pair_sure


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Train on at most ``per_language`` rows of each language outside the held-out fold."""
    rows = (docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
            .filter((F.trim("lang") != "") & F.col("text").isNotNull()).filter(F.coalesce(text_id("id"), F.lit(1)) != 0)
            .select("lang", F.xxhash64(F.lit(1), "id", "text").alias("rank"), excerpts(F.col("text"), TRAIN_CHARS).alias("text")))
    # ids and texts are ranked by hash, rows that repeat both count once; the few chosen rows are fetched by a range on the rank
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("rank").alias("n")).collect()  # one row per language
    if not counts:
        return None
    # a hash below this is expected for twice the wanted rows; the exact cut follows among those
    cut = F.lit(None).cast("double")
    for r in counts:
        cut = F.when(F.col("lang") == r["lang"], F.lit(-2.0**63 + 2.0**64 * min(1.0, 2 * per_language / r["n"] + 50 / r["n"]))).otherwise(cut)
    few = rows.filter(F.col("rank") <= cut).groupBy("lang", "rank").agg(F.min("text").alias("text"))
    chosen = few.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "text"))).filter(F.col("place") <= per_language)
    got = chosen.select("lang", "rank", "text").toArrow().sort_by([("lang", "ascending"), ("rank", "ascending"), ("text", "ascending")])
    langs = sorted(set(got["lang"].to_pylist()))
    index = {lang: i for i, lang in enumerate(langs)}
    x = np.concatenate([features(data, bounds) for b in got.combine_chunks().to_batches() for _, data, bounds in ts.slices([b], "text")])
    return Model(langs, x, np.array([index[v] for v in got["lang"].to_pylist()]))


def _predictor(model: Model | None):
    def run(batches):
        for batch, data, bounds in ts.slices(batches, "text", ts.SLICE_BYTES // 2):
            for start in range(0, batch.num_rows, 256):  # bounds the feature matrix to 256 rows
                part = batch.slice(start, 256)
                edges = bounds[start:start + part.num_rows + 1]
                own = data[edges[0]:edges[-1]]
                lettered = has_letters(part.column(1))
                if model is None:
                    langs, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                else:
                    at, scores = model.predict(features(own, edges - edges[0]))
                    langs = [model.langs[i] if ok else UNKNOWN for i, ok in zip(at, lettered)]
                    scores = np.where(lettered, scores, 0.0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores)], names=["id", "lang_pred", "score"])
    return run


def has_letters(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, lang_pred, score) per row of docs; learned from the rows outside the held-out fold."""
    model = fit(docs, id_col, text_col, lang_col)
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_predictor(model), "id bigint, lang_pred string, score double")
