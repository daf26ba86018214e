"""The divergence cube against brute force, with few and with many blocks."""

import random
import re
from collections import Counter

import pytest

from kestrel.llm import divergence

from llm_rows import DOCS, shipped  # noqa: F401 (fixtures)

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    docs = [(lang or "", source or "", Counter(WORD.findall((text or "").translate(FOLD)))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        kept = [t for t, n in Counter(t for d in mine for t in d[2]).items() if n >= 3]
        counts = {s: Counter() for s in {d[1] for d in mine}}
        for _, source, words in mine:
            counts[source].update({t: n for t, n in words.items() if t in kept})
        whole = sum(counts.values(), Counter())
        p = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        f = lambda a, b: (a - b) * (a - b) // b
        for s, c in counts.items():
            pairs = [(sum(f(p(c, t), p(o, t)) for t in kept), other) for other, o in counts.items() if other != s]
            terms = [(f(p(c, t), p(whole, t)), t) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, items, most in (("pair", pairs, None), ("term", terms, 200)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def corpus(seed, n, sources):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("x", "é", "Zz", "ß")] + ["naïve", "A", "a", "word's", "x1y", "日本"]
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else f"s{rng.randrange(sources)}"
        text = " ".join(rng.choice(words) if rng.random() < 0.9 else f"rare{rng.randrange(10**6)}" for _ in range(rng.randint(0, 40)))
        rows.append((rng.randrange(50), text, rng.choice(["en", "fr", None]), source, 0))
    rows += [(1, None, "en", "silent", 0), (1, "", "xx", "alone", 0), (2, "12 34", "yy", "a", 0), (2, "few", "yy", "b", 0), (None, "few few", "yy", None, 0),
             (7, "same same", "zz", "p", 0), (7, "same same", "zz", "p", 0), (7, "same same", "zz", "p", 0), (7, "other", "zz", "q", 0), (8, "", "zz", "", 0)]
    return rows


def audited(spark, rows):
    table = spark.createDataFrame([(*r, "t", 1, 2) for r in rows], DOCS + ", term string, n int, p int")
    return sorted(tuple(r) for r in divergence.audit(table).select("lang", "source", "part", "item", "value", "rank").collect())


def test_audit_matches_brute_force(spark):
    rows = corpus(1, 120, 4)
    assert audited(spark, rows) == brute(rows)


def test_many_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(divergence, "GROUPS", 2)
    monkeypatch.setattr(divergence, "TERMS", 4)
    rows = corpus(2, 150, 9)
    assert audited(spark, rows) == brute(rows)


def test_an_empty_table_and_one_without_terms(spark):
    assert audited(spark, []) == []
    assert audited(spark, [(1, None, None, None, 0), (2, "1 2", None, "b", 0)]) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


@pytest.mark.parametrize("total", [1, 7, 10**9 + 7, (1 << 53) - 1])
def test_scaled_probabilities_are_exact(spark, total):
    counts = sorted({0, total // 3, max(total - 1, 0)})
    df = spark.createDataFrame([(c, total) for c in counts], "c bigint, t bigint")
    got = [r.p for r in df.orderBy("c").select(divergence.scaled("c", "t").alias("p")).collect()]
    assert got == [1 + 10**9 * (c + 1) // total for c in counts]


def test_counts_of_a_very_long_text(spark):
    rows = [(i, "Word und wort " * 100_000, "de", f"s{i}", 0) for i in range(3)]
    assert audited(spark, rows) == brute(rows)
