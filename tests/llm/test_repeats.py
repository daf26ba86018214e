"""Substring dedup over words and bytes against brute force, and the near-duplicate groups."""

import hashlib
import random
import re

import numpy as np
import pytest

from kestrel.llm import minhash, queries, repeats, rlz_dedup, suffix_dedup, textscan as ts

from llm_rows import SF, docs, frame, shipped  # noqa: F401 (fixtures)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(sequences, window):
    """Covered positions per sequence; windows of earlier sequences (in order) come first."""
    seen, out = set(), []
    for s in sequences:
        drop = np.zeros(len(s), dtype=bool)
        for p in range(len(s) - window + 1):
            w = tuple(s[p:p + window])
            if w in seen:
                drop[p:p + window] = True
            seen.add(w)
        out.append(drop)
    return out


def runs(drop):
    return int((np.diff(np.append(0, drop.astype(int))) == 1).sum())


def random_texts(seed, n):
    rng = random.Random(seed)
    shared = [" ".join(rng.choice("ab cd e fgh ij klm n op q r".split()) for _ in range(rng.randint(5, 60))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choice("ab cd e fgh é ñandú".split()) for _ in range(rng.randint(0, 40)))
                 for _ in range(rng.randint(0, 5))]
        out.append(rng.choice([" ", "\n", "\t  "]).join(parts))
    return out


EDGES = [(5, None), (6, ""), (7, "   \n"), (8, "one"), (9, "a " * 400), (10, "a " * 400), (11, "x" * 5000), (12, "ß" * 300 + "x" * 200)]


@pytest.mark.parametrize("seed", [1, 2])
def test_word_windows_match_brute_force(spark, seed):
    rows = EDGES + list(enumerate(random_texts(seed, 60), 100))
    got = {r.id: r for r in rlz_dedup.parse(frame(spark, rows)).collect()}
    words = [WORD.findall(t or "") for _, t in rows]
    for (i, _), w, drop in zip(rows, words, brute(words, 20)):
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (len(w), drop.sum(), " ".join(x for x, d in zip(w, drop) if not d))
        assert (got[i].n_factors > 0) == (got[i].n_removed > 0)


@pytest.mark.parametrize("batches", [1, 2, 3, 4, 5])
def test_byte_windows_match_brute_force_for_any_number_of_batches(spark, batches):
    rows = EDGES + list(enumerate(random_texts(3, 40), 100))
    got = {r.id: r for r in suffix_dedup.remove(frame(spark, rows), batches=batches).collect()}
    data = [(t or "").encode() for _, t in rows]
    for (i, _), s, drop in zip(rows, data, brute(data, 100)):
        kept = bytes(np.frombuffer(s, np.uint8)[~drop])
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == (len(s), drop.sum(), runs(drop), kept)


def test_crowded_anchors_are_settled_window_by_window(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", 1)  # on the driver; tasks of local mode load their own copy
    rows = list(enumerate(random_texts(4, 30)))
    groups = repeats.groups_of(*suffix_dedup.byte_symbols(np.frombuffer(b"".join((t or "").encode() for _, t in rows), np.uint8),
                                                         np.cumsum([0] + [len(t.encode()) for _, t in rows])), np.arange(len(rows)), 100, 32)
    ordered, lead, _ = repeats.settle(groups)
    kinds = {kind for _, kind, _ in repeats.open_rows(ordered[lead])}
    assert kinds == {repeats.CROWDED}
    found = spark.createDataFrame([(k, kind, bytes(s)) for k, kind, s in repeats.open_rows(ordered[lead])], repeats.SETTLED)
    own = spark.createDataFrame([(i, t) for i, t in rows], f"{repeats.KEY} bigint, text string")
    def spans(df):
        return {(r[0], int(a)) for r in df.collect() for s in np.frombuffer(r.spans, repeats.SPAN) for a in range(s["at"], s["at"] + s["n"])}
    one = spans(repeats.windows_of(own, found, suffix_dedup.byte_symbols, 100, 4))
    other = spans(repeats.edges_of(own, found.withColumn("kind", found.kind * 0 + repeats.OPEN), suffix_dedup.byte_symbols, 100, 32, 4))
    assert one == other and one


def test_repeated_and_null_ids_are_told_apart(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (None, text), (3, text), (3, text), (3, text + " tail"), (4, "other words")]
    got = sorted((r.id is not None, r.id or 0, r.n_words, r.n_removed) for r in rlz_dedup.parse(frame(spark, rows)).collect())
    # the null id comes first, its two equal rows are one document; everything after repeats it
    assert got == [(False, 0, 30, 0), (False, 0, 30, 0), (True, 3, 30, 30), (True, 3, 30, 30), (True, 3, 31, 30), (True, 4, 2, 0)]
    near = sorted((r.id is not None, r.id or 0, r.component_id, r.kept) for r in minhash.groups(frame(spark, rows)).collect())
    assert [x[2] for x in near] == [None] * 5 + [4] and [x[3] for x in near] == [True, True, False, False, False, True]


def test_empty_tables(spark):
    none = frame(spark, [])
    assert rlz_dedup.parse(none).count() == 0
    assert suffix_dedup.remove(none).count() == 0
    assert minhash.groups(none).count() == 0


def test_kept_text_keeps_its_white_space(spark):
    text = "".join(f"w{i}\n" for i in range(25))
    rows = [(1, text), (2, " lead " + text + "tail\tx\n")]
    got = {r.id: r.kept for r in rlz_dedup.parse(frame(spark, rows), single_spaces=False).collect()}
    assert got == {1: text, 2: " lead tail\tx\n"}


def test_registered_queries_on_the_whole_table(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    words, data = [WORD.findall(t) for _, t in rows], [t.encode() for _, t in rows]
    by_word = {r.doc_id: r for r in queries.QUERIES["op10_substring_dedup"](spark, SF).collect()}
    by_byte = {r.doc_id: r for r in queries.QUERIES["op6_suffix_array_dedup"](spark, SF).collect()}
    for (i, _), w, s, drop_w, drop_s in zip(rows, words, data, brute(words, 20), brute(data, 100)):
        kept = " ".join(x for x, d in zip(w, drop_w) if not d).encode()
        assert (by_word[i].n_removed, by_word[i].kept_sha256) == (drop_w.sum(), hashlib.sha256(kept).hexdigest())
        kept = bytes(np.frombuffer(s, np.uint8)[~drop_s])
        assert (by_byte[i].n_removed, by_byte[i].n_spans, by_byte[i].kept_sha256) == (drop_s.sum(), runs(drop_s), hashlib.sha256(kept).hexdigest())


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def exact_components(rows, percent):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [rows[find(i)][0] for i in range(len(rows))], [len(s) for s in sets]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_exact_comparison(spark, percent):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, t) for i, t in EDGES]
    for family in range(6):  # chains of copies that drift away from the first
        text = [rng.choice(words) for _ in range(150)]
        for copy in range(25):
            rows.append((100 * (family + 1) + copy, " ".join(text)))
            text = list(text)
            text[rng.randrange(len(text))] = rng.choice(words).upper()
    rows = sorted(rows)
    want, sizes = exact_components(rows, percent)
    got = sorted(minhash.groups(frame(spark, rows), percent=percent).collect(), key=lambda r: r.id)
    assert [r.component_id for r in got] == want
    assert [r.n_shingles for r in got] == sizes
    assert [r.kept for r in got] == [r.id == r.component_id for r in got]


def test_estimates_are_close_to_the_true_similarity():
    rng = np.random.Generator(np.random.PCG64(1))
    base = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    for share in (0.3, 0.6, 0.85, 0.95):
        n = int(round(2000 * 2 * share / (1 + share)))
        other = np.concatenate([base[:n], rng.integers(0, 1 << 63, 2000 - n, dtype=np.uint64)])
        fine = minhash.fine_signatures(np.concatenate([base, other]), np.array([0, 2000])).view(np.uint64)
        assert abs(float(minhash.estimate(fine[0], fine[1])) - n / (4000 - n)) < 0.08


def test_hashes_of_ranges_do_not_depend_on_their_place():
    data = np.frombuffer(b"abc abc xabc", np.uint8)
    h = ts.range_hashes(ts.byte_values(data), np.array([0, 4, 9]), np.array([3, 7, 12]))
    assert h[0] == h[1] == h[2]
    grams = ts.kgrams(ts.byte_values(data), 3)
    assert grams[0] == grams[4] == grams[9] and len(grams) == 10
    values = np.array([5, 3, 3, 9, 1, 7], dtype=np.uint64)
    assert ts.leftmost_minima(values, 3).tolist() == [1, 1, 4, 4]
