"""License scan with a positional index of rare words, with DataFrame operations only.

One pass over the texts keeps, per document, the places of the words that occur in any template
(its licence words). Over all documents these give the words' document frequencies, hence IDF. The
index lists for each template its RARE highest-IDF words with their offsets. A document is looked up by its
licence words of highest IDF: a template's start is possible only where the places of all its
rare words, less their offsets, agree. There the template's mandatory phrase is verified with the
places of its other words; licence words of every place are at hand, so no text is read again, and
the work grows with the number of a document's licence words, however they repeat.

Words are maximal runs of ASCII letters and digits and non-ASCII characters; A-Z compare like a-z.
Score: 0 without a label, else the largest IDF mass of a found template relative to the heaviest template.

Defined results: null text has no word; documents are scanned row by row, so null and repeated ids
do no harm; places count once per phrase and start; equal IDFs go by the word; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from kestrel.llm.common import stored

RARE = 2

#: The base phrases and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Mandatory phrases of further licences.
FURTHER = (
    ("gnu general public license version 2", "gpl-2"),
    ("gnu general public license version 3", "gpl-3"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("boost software license", "bsl-1"),
    ("permission is hereby granted free of charge", "mit"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("creative commons attribution", "cc-by"),
    ("released into the public domain", "public-domain"),
)

#: A word of the texts, in any case of A-Z.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def vocabulary(phrases) -> list[str]:
    return sorted({w for phrase, _ in phrases for w in phrase.split()})


def licence_words(docs: DataFrame, words: list[str], id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, hits): hits are place * len(words) + index of the word, for every licence word."""
    listed = ", ".join(f"'{w}'" for w in words)
    found = docs.select(F.col(id_col).cast("bigint").alias("id"),
                        F.regexp_extract_all(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD), F.lit(0)).alias("words"))
    # lower() maps one character beyond ASCII, the kelvin sign, into a-z: no template has a k
    hits = f"""transform(filter(transform(words, (w, i) -> named_struct('w', lower(w), 'i', i)), s -> s.w in ({listed})),
                         s -> cast(s.i as bigint) * {len(words)} + array_position(array({listed}), s.w) - 1)"""
    return found.select("id", F.size("words").cast("bigint").alias("n_words"), F.expr(hits).alias("hits"))


def inverse_frequencies(found: DataFrame, words: list[str]) -> dict[str, float]:
    """IDF of every licence word over all documents (one row per word reaches the driver)."""
    n = found.count()
    each = found.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h % len(words)))).alias("word"))
    df = {r["word"]: r["n"] for r in each.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: math.log((n + 1) / (df.get(i, 0) + 1)) for i, w in enumerate(words)}


def rare_words(phrase: str, idf: dict[str, float], rare: int = RARE) -> list[tuple[str, int]]:
    """The phrase's words of highest IDF, with the offset of their first place in it."""
    words = phrase.split()
    return [(w, words.index(w)) for w in sorted(set(words), key=lambda w: (-idf[w], w))[:rare]]


def places(phrase: str, words: list[str], idf: dict[str, float]) -> Column:
    """Column: sorted starts of the phrase. The rare words' postings, shifted by their offsets, are intersected; where
    that leaves any start, the other words' are too, which verifies the phrase at all starts in one pass over the hits."""
    n = len(words)

    def posting(word, offset):
        code = words.index(word)
        return F.transform(F.filter("hits", lambda h: h % n == code), lambda h: F.floor(h / n) - offset)

    rare = rare_words(phrase, idf)
    rest = [(word, j) for j, word in enumerate(phrase.split()) if (word, j) not in rare]
    possible, *others = (posting(word, offset) for word, offset in rare)
    for other in others:
        possible = F.array_intersect(possible, other)  # by hashing: linear in the postings
    verified = possible
    for word, offset in rest:
        verified = F.array_intersect(verified, posting(word, offset))
    return F.when(F.size(possible) > 0, verified).otherwise(possible)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, further=FURTHER) -> DataFrame:
    """One row per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score, and
    ``found``: an array of (label, starts) for every template met."""
    phrases = (*base, *further)
    words = vocabulary(phrases)
    found = stored(licence_words(docs, words, id_col, text_col))
    idf = inverse_frequencies(found, words)
    mass = [sum(idf[w] for w in set(phrase.split())) for phrase, _ in phrases]
    heaviest = max(max(mass), 1e-9)
    # most documents have none of the index words: they skip the look-up
    keys = sorted({words.index(rare_words(phrase, idf, 1)[0][0]) for phrase, _ in phrases})
    some = F.exists("hits", lambda h: (h % len(words)).isin(keys))
    templates = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(k < len(base)).alias("base"), F.lit(mass[k] / heaviest).alias("mass"),
                                   places(phrase, words, idf).alias("starts")) for k, (phrase, label) in enumerate(phrases)])
    kind = "array<struct<label:string,base:boolean,mass:double,starts:array<bigint>>>"
    met = F.when(some, F.filter(templates, lambda t: F.size(t["starts"]) > 0)).otherwise(F.array()).cast(kind)
    out = found.select("id", "n_words", met.alias("found")).withColumn("base_found", F.filter("found", lambda t: t["base"]))
    starts = F.flatten(F.transform("base_found", lambda t: t["starts"]))

    def joined(column):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda t: t["label"]))), ",")
    return out.select("id", "n_words", F.size(starts).cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                      joined("base_found").alias("base_labels"), joined("found").alias("labels"),
                      F.coalesce(F.array_max(F.transform("found", lambda t: t["mass"])), F.lit(0.0)).alias("score"), "found")
