"""Quality rules, licences, language, toxicity, leaks, packing, chat windows and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kestrel.llm import chat_format, curve_packing, decontam, langid, licenses, llr_quality, minhash, queries, toxicity
from kestrel.llm import textscan as ts

from llm_rows import SF, docs, frame, shipped  # noqa: F401 (fixtures)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "x"), (5, "x" * 30_000), (6, "a b c d e f g h " * 300), (7, "é ß 漢字 🙂"), (None, "no id here"), (7, "twice the id")]


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


# ------------------------------------------------------------------ quality rules

def quality_base(text):
    words = WORD.findall(text or "")
    lines, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in lines
            lines.add(line)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(inside), failed


def brute_scores(texts, trusted):
    """The same score from dictionaries of bucket numbers."""
    grams = []
    for t in texts:
        data = np.frombuffer((t or "").encode(), np.uint8)
        words = ts.Words(data, np.array([0, len(data)]))
        hashes = [int(h) for h in ts.word_hashes(data, words)]
        pairs = [int(ts.kgrams(np.array(p, dtype=np.uint64), 2)[0]) for p in zip(hashes, hashes[1:])]
        grams.append([h % llr_quality.BUCKETS for h in hashes + pairs])
    raw = Counter(g for gs in grams for g in gs)
    target = Counter(g for gs, ok in zip(grams, trusted) if ok for g in gs)
    def share(c, g):
        return (c[g] + llr_quality.SMOOTHING) / (sum(c.values()) + llr_quality.SMOOTHING * llr_quality.BUCKETS)
    return [sum(np.log(share(target, g) / share(raw, g)) for g in gs) / max(len(gs), 1) for gs in grams]


def test_quality_rules_match_brute_force(spark, docs):
    rows = EDGES + [(100 + r.doc_id, r.text) for r in docs.limit(25).collect()]
    rows += [(900, "line one\nline one\n\nline two | <b> line one\nline one")]
    trusted = [i is not None and i >= 100 and i % 2 == 0 for i, _ in rows]
    labels = labelled(spark, [(i, 1, 0) for (i, _), ok in zip(rows, trusted) if ok] + [(rows[-1][0], None, None), (4, 0, 0), (100, 1, 0)])
    got = llr_quality.judge(frame(spark, rows), labels).collect()
    want = sorted((i is not None, i or 0, *quality_base(t), round(s, 9)) for (i, t), s in zip(rows, brute_scores([t for _, t in rows], trusted)))
    have = sorted((r.id is not None, r.id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, round(r.score, 9)) for r in got)
    assert have == want
    assert all(r.kept == (not r.base_failed and r.score >= llr_quality.THRESHOLD) for r in got)


def test_quality_without_labels_or_rows(spark):
    got = llr_quality.judge(frame(spark, EDGES), labelled(spark, [])).collect()
    assert all(r.score == 0 for r in got) and len(got) == len(EDGES)
    assert llr_quality.judge(frame(spark, []), labelled(spark, [])).count() == 0


def test_quality_keeps_trusted_documents_and_drops_junk(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.QUERIES["op4_llr_quality"](spark, "/root/testdata/sf0.01").join(rows, "doc_id").where("not base_failed")
    share = {r.quality: r.kept for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 0.99 and share[0] <= 0.2


@pytest.mark.parametrize("one_in", [1, 10, 100])
def test_quality_keeps_good_documents_however_few_are_trusted(spark, tmp_path, one_in):
    d = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{d}/labels.parquet")
    good = sorted(r.doc_id for r in rows.where("quality = 1").select("doc_id").distinct().collect())
    spark.read.parquet(f"{d}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    labelled(spark, [(i, 1, 0) for i in good[::one_in]]).write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.QUERIES["op4_llr_quality"](spark, str(tmp_path)).where("not base_failed").join(rows, "doc_id")
    share = {r.quality: r.kept for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 0.97
    assert one_in > 1 or share[0] <= 0.2


def test_no_evidence_gives_ratio_zero():
    raw = np.zeros(llr_quality.BUCKETS)
    raw[:3] = 1_000_000, 1000, 1
    target = np.zeros(llr_quality.BUCKETS)
    target[1] = 1
    assert np.abs(llr_quality.log_ratios(target, raw, llr_quality.TOWARD_RAW)[[0, 2]]).max() < 1e-4
    assert np.allclose(llr_quality.log_ratios(raw, raw, llr_quality.TOWARD_RAW)[:3], 0)


# ------------------------------------------------------------------ licences

def licence_base(text):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    starts, labels, every = [], set(), set()
    for group, phrases in (("base", licenses.BASE), ("further", licenses.FURTHER)):
        for phrase, label in phrases:
            p = phrase.split()
            here = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
            if here:
                every.add(label)
                if group == "base":
                    starts += here
                    labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(every))


def test_licences_match_brute_force(spark, docs):
    texts = ["Released under the MIT License. Under The mit-license; under the mit licenses", "Apache License, Version 2.0, apache license version 2",
             "CC BY-NC 4.0 cc by nc cc by sa", "under the MIT", "GNU General Public License, version 3. gnu general public license version 2",
             "Redistribution and use in source and binary forms, and use in source", "UNDER THE MİT LICENSE under the mit license"]
    rows = EDGES + list(enumerate(texts, 100)) + [(1000 + r.doc_id, r.text) for r in docs.collect()]
    got = sorted((r.id is not None, r.id or 0, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in licenses.scan(frame(spark, rows)).collect())
    none = lambda t: tuple(-1 if x is None else x for x in t)
    assert sorted(map(none, got)) == sorted(none((i is not None, i or 0, *licence_base(t))) for i, t in rows)
    scores = [r.score for r in licenses.scan(frame(spark, rows)).collect()]
    assert all(0 <= s <= 1 for s in scores) and max(scores) > 0
    assert licenses.scan(frame(spark, [])).count() == 0


def test_native_operators_run_no_python(spark):
    for name in ("op2_chat_formatting", "op5_license_scan"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# ------------------------------------------------------------------ language

def test_languages_on_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    got = queries.QUERIES["op8_language_id"](spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n")), "doc_id")
    held = got.where("held_out and n >= 50").select("lang", "lang_pred").collect()
    assert len(held) > 100 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.98


def test_language_edges(spark):
    english, german = "the house and the garden of that man " * 3, "der Garten und das Haus von dem Mann " * 3
    rows = [(i, english if i % 2 else german) for i in range(10, 40)] + EDGES + [(99, "1234 !!")]
    docs = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id").between(10, 39), F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de")))
    got = {(r.id, r.score): r.lang_pred for r in langid.predict(docs).collect()}
    assert {p for (i, s), p in got.items() if i in (1, 2, 3, 99)} == {"und"} and all(s == 0 for (i, s) in got if i in (1, 2, 3, 99))
    assert all(p == ("en" if i % 2 else "de") for (i, _), p in got.items() if i is not None and 10 <= i < 40)
    assert {r.lang_pred for r in langid.predict(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert {r.lang_pred for r in langid.predict(docs.withColumn("lang", F.lit("en"))).where("id > 9 and id < 40").collect()} == {"en"}
    assert langid.predict(frame(spark, [])).count() == 0
    assert langid.family_of("de") == langid.family_of("en-GB") == "germanic" and langid.family_of("xx") == "xx"


def test_language_sample_takes_repeated_rows_once(spark, monkeypatch):
    monkeypatch.setattr(langid, "Model", lambda langs, x, y: x)
    rows = [(None, "aaaa")] * 300 + [(None, f"text {chr(98 + i % 24)}{chr(98 + i // 24)}") for i in range(40)]
    x = langid.fit(frame(spark, rows).withColumn("lang", F.lit("en")), "doc_id", "text", "lang", per_language=20)
    assert len(x) == len(np.unique(x, axis=0)) == 20


# ------------------------------------------------------------------ toxicity

def slow_kernel(a, b):
    """Gap-weighted subsequences of three characters by enumeration, normalised."""
    def features(w):
        w = b"\x02" + w + b"\x03"
        out = Counter()
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + toxicity.SPAN)):
                    out[w[i], w[j], w[k]] += toxicity.DECAY ** (k - i + 1)
        return out
    x, y = features(a), features(b)
    dot = lambda p, q: sum(v * q[k] for k, v in p.items())
    return dot(x, y) / np.sqrt(dot(x, x) * dot(y, y))


def test_kernel_matches_enumeration():
    words = [b"idiot", b"idxiot", b"banana", b"an", "señor".encode(), b"x" * toxicity.MAX_WORD]
    got = toxicity.Kernel(words)(words)
    assert got == pytest.approx(np.array([[slow_kernel(a, b) for b in words] for a in words]))


def invented(seed, n):
    rng = random.Random(seed)
    syllables = "ba co du fe gi lo mu na pe ri so ta vu we".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    texts, labels = [], []
    for i in range(n):
        sentences = [" ".join(word() for _ in range(8)) for _ in range(6)]
        bad = i % 3 == 0
        if bad:
            sentences[rng.randrange(6)] += " " + rng.choice(["kraxli", "kraxlo", "kraxlen", "zhumpf", "zhumpfer"])
        texts.append(". ".join(sentences) + ".")
        labels.append(int(bad))
    return texts, labels


def test_toxic_words_are_found_with_gaps_and_insertions():
    texts, labels = invented(1, 240)
    machine = toxicity.fit_texts(texts, np.array(labels), 1 / 3)
    def score(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return machine.score(toxicity.document_margins(machine, 1, data, np.array([0, len(data)])))[0]
    held, want = invented(2, 90)
    assert np.mean([(score(t) >= 0.5) == y for t, y in zip(held, want)]) >= 0.95
    for text in ("ba kraxli na", "ba kra*xli na", "ba k r a x l i na", "ba KRAXLI!", "ba kraxzli na", "na zhump-fer so"):
        assert score(text) >= 0.5, text
    assert score("ba na so ta") < 0.5 and score("") < 0.5
    # folding the machine into subsequence weights is exact
    words = [b"kraxli", b"banana", b"zhumpfk"]
    whole = machine.margins(toxicity.matrix(words))
    codes, weights = toxicity.subsequences(toxicity.matrix(words))
    slow = [machine.bias + sum(machine.weights[toxicity.find(machine.codes, np.array([c]))[0]] * w for c, w in zip(row, weights) if c) / n
            for row, n in zip(codes, toxicity.norms(codes, weights))]
    assert whole == pytest.approx(np.array(slow))


def test_mislabelled_documents_do_not_make_insults_clean():
    texts, labels = invented(1, 900)
    rng = random.Random(9)
    marks = np.array([1 - y if rng.random() < 0.02 else y for y in labels])
    machine = toxicity.fit_texts(texts, marks, 1 / 3)
    def score(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return machine.score(toxicity.document_margins(machine, 2, data, np.array([0, len(data)])))[0]
    toxicity._known.clear()
    held, want = invented(2, 150)
    found = np.array([score(t) >= 0.5 for t in held])
    assert found[np.array(want) == 1].mean() >= 0.95 and found[np.array(want) == 0].mean() <= 0.1


def test_a_repeated_id_sends_one_text_to_the_driver(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(toxicity, "fit_texts", lambda texts, y, share: sent.append(texts))
    ids = [i for i in range(1, 60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(ids[0], f"text {i}") for i in range(300)] + [(i, f"other {i}") for i in ids[1:]]
    toxicity.fit(frame(spark, rows), labelled(spark, [(i, 1, i % 2) for i in ids]))
    assert len(sent[0]) == len(ids)


def test_toxicity_edges(spark):
    texts, labels = invented(3, 120)
    rows = [(i + 100, t) for i, t in enumerate(texts)] + EDGES
    marks = labelled(spark, [(i + 100, 1, y) for i, y in enumerate(labels)] + [(100, 1, None), (None, 1, 1), (4, None, None)])
    got = toxicity.score(frame(spark, rows).drop("score"), marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.id in (1, 2, 3)} == {next(r.score for r in got if r.id == 2)}
    again = toxicity.score(frame(spark, list(reversed(rows))).repartition(3).drop("score"), marks).collect()
    assert sorted((r.id or -1, r.score) for r in got) == sorted((r.id or -1, r.score) for r in again)
    assert {r.score for r in toxicity.score(frame(spark, EDGES).drop("score"), labelled(spark, [])).collect()} == {0.0}
    assert toxicity.score(frame(spark, []).drop("score"), marks).count() == 0


def test_long_words_and_spaced_letters():
    data = np.frombuffer(("a" * 60 + " b c d e f gh").encode(), np.uint8)
    words = ts.Words(data, np.array([0, len(data)]))
    starts, ends, _ = toxicity.pieces(data, words)
    covered = set().union(*(range(a, b) for a, b in zip(starts, ends)))
    assert set(range(60)) <= covered and (ends - starts).max() <= toxicity.MAX_WORD
    assert toxicity.spaced_words(data, words) == [(0, b"bcdef")]


# ------------------------------------------------------------------ leaks

def slow_tiles(doc, item, k):
    """Greedy string tiling by its definition."""
    marked_doc, marked_item, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and i + n not in marked_item and d + n not in marked_doc:
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < k:
            return tiles
        tiles.append((i, d, n))
        marked_item.update(range(i, i + n))
        marked_doc.update(range(d, d + n))


@pytest.mark.parametrize("seed", range(8))
def test_tiling_matches_its_definition(seed):
    rng = random.Random(seed)
    item = [rng.choice("abcdefg") for _ in range(30)]
    doc = item[15:30] + [rng.choice("abcdefg") for _ in range(10)] + item[:15] + [rng.choice("abcdefg") for _ in range(10)]
    def seeds(tokens):
        data = np.frombuffer(" ".join(tokens).encode(), np.uint8)
        found, _, at, _ = decontam.seeds_of(data, np.array([0, len(data)]), 4)
        return at, found.view(np.int64)
    got = decontam.tile(*seeds(doc), *seeds(item), 4)
    assert got == slow_tiles(doc, item, 4)


def test_leaks(spark):
    rng = random.Random(3)
    token = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    item = [token() for _ in range(40)]
    noise = lambda n: " ".join(token() for _ in range(n))
    text = " ".join(item)
    rows = EDGES + [(100, f"{noise(50)} {text} {noise(50)}"), (101, f"{noise(9)} {' '.join(item[20:])} {noise(9)} {' '.join(item[:20])}"),
                    (102, text.upper().replace(" ", ", ")), (103, noise(200)), (104, f"{noise(5)} {' '.join(item[:10])} {noise(5)}"), (None, text), (100, "clean")]
    bench = spark.createDataFrame([(1, text, 0), (2, None, 0), (3, "too short", 0), (4, text, 0), (None, text, 0)], "item_id bigint, text string, id int")
    got = {(r.id, r.item): r.coverage for r in decontam.leaks(frame(spark, rows), bench).collect()}
    assert got == {(i, j): 1.0 for i in (100, 101, 102, None) for j in (1, 4, None)}
    assert decontam.leaks(frame(spark, []), bench).count() == 0
    assert decontam.leaks(frame(spark, rows), bench.limit(0)).count() == 0


def test_leaks_of_items_with_repeated_runs(spark):
    runs, verse = "0 1 " * 30, " ".join(f"line{i} la la la la la la la la" for i in range(6))
    rows = [(1, f"{numbered('a')} {runs} {numbered('b')}"), (2, verse), (3, "0 1 " * 10 + numbered("c")), (4, numbered("d"))]
    bench = spark.createDataFrame([(1, runs), (2, verse)], "item_id bigint, text string")
    got = {(r.id, r.item): r.coverage for r in decontam.leaks(frame(spark, rows), bench).collect()}
    assert got == {(1, 1): 1.0, (2, 2): 1.0}


def test_benchmark_passages_in_the_table_are_caught(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(d.doc_id, b.item_id) for d in docs.collect() for b in bench if b.text in d.text}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op3_benchmark_decontamination"](spark, SF).collect()}
    assert want and want <= got


# ------------------------------------------------------------------ packing

def test_packing_is_an_exact_round_trip(spark):
    rows = EDGES + [(20, "It's O'Neil <|endoftext|> ok"), (21, "ÀÉ×÷ ÿ1234 ##a b"), (22, "word " * 5000), (23, "日本 text")]
    got = curve_packing.pack(frame(spark, rows), size=128).collect()
    tokenizer = curve_packing.tokenizer_at(curve_packing.TOKENIZER)
    want = Counter()
    for i, t in rows:
        want[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])] += 1
    whole, here = Counter(), {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        ids = np.frombuffer(r.ids, "<u2")
        assert r.length == len(ids) and r.ids_crc32 == zlib.crc32(ids.astype("<u4").tobytes())
        here.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.start == 0:
            parts, size = [], r.doc_tokens
        parts.append(ids)
        if r.start + r.length == size:
            whole[r.doc_id, tuple(np.concatenate(parts).tolist())] += 1
    assert whole == want
    for s, pieces in here.items():
        assert [o for o, _ in pieces] == np.append(0, np.cumsum([n for _, n in pieces]))[:-1].tolist()
        assert sum(n for _, n in pieces) == 128 or s == max(here)
    assert sorted(here) == list(range(len(here)))
    assert curve_packing.pack(frame(spark, [])).count() == 0


def test_hilbert_neighbours_touch():
    side = np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    key = curve_packing.hilbert(side, 3)
    assert sorted(key) == list(range(512))
    path = side[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


# ------------------------------------------------------------------ chat

def turns(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, conv string")


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(12):
        if conv % 3 == 0:
            rows.append((conv, 0, "system", "be kind " * rng.choice([1, 40])))
        for turn in range(1, rng.choice([2, 9, 60])):
            text = rng.choice(["", None, "</s>[INST] ok [/INST]", "\\l \\e <|im_end|>\n<|im_start|>user", "word " * rng.randint(1, 120), "é\n漢字 <<SYS>>"])
            rows.append((conv, turn, "assistant" if turn % 2 == 0 else rng.choice(["user", "user", None, "a\nb<|im_end|>"]), text))
    rows += [(50, 1, "system", "alone"), (51, None, "user", "no turn"), (51, None, "assistant", "none"), (51, 1, "assistant", "x"), (51, 1, "assistant", "x"),
             (None, 1, "user", "q"), (None, 2, "assistant", "a"), (52, 1, "user", "y " * 900), (52, 2, "assistant", "z " * 900)]
    return rows


@pytest.mark.parametrize("budget,history", [(2048, 512), (300, 60), (300, 0)])
def test_chat_round_trip_and_budget(spark, budget, history):
    rows = conversations(4)
    made = chat_format.windows(turns(spark, rows), budget=budget, history=history)
    back = {r.conv: r for r in chat_format.read_back(made).collect()}
    by_conv = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by_conv.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(back) == set(by_conv)
    for conv, said in by_conv.items():
        assert back[conv].said == "".join(f"{a}\n{b}\n" for a, b in said)
        assert back[conv].loss == "".join(b for a, b in said if a == "assistant")
        assert back[conv].n_turns == len(said)
    cost = lambda t: len(re.findall(r"\w+|[^\w\s]", t, re.ASCII)) + chat_format.MARKERS
    shown = {}
    for w in made.collect():
        parts = w.formatted.split(chat_format.STOP + "\n")[:-1]
        assert all(p.startswith(chat_format.START) for p in parts) and len(parts) == w.n_system + w.n_history + w.n_targets
        system = parts[:w.n_system]
        assert all(p.startswith(chat_format.START + "system\n") for p in system)
        price = lambda ps: sum(cost(p.split("\n", 1)[1].replace("\\e", "\\")) for p in ps)
        assert price(parts[w.n_system:w.n_system + w.n_history]) <= history * 1.5
        shown.setdefault(w.conv, []).append((w.first, w.n_targets))
    for conv, spans in shown.items():  # targets follow each other without gaps
        spans.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert chat_format.windows(turns(spark, [])).count() == 0


def test_chat_long_conversation_is_cut_into_windows_with_history(spark):
    rows = [(1, 0, "system", "sys")] + [(1, t, "user" if t % 2 else "assistant", f"t{t} " + "w " * 40) for t in range(1, 700)]
    made = chat_format.windows(turns(spark, rows), budget=500, history=100).orderBy("first").collect()
    assert len(made) > 60 and all(w.n_system == 1 for w in made) and all(w.n_history >= 1 for w in made[1:])
    assert sum(w.n_targets for w in made) == 699
    assert sum(len(w.loss_spans) for w in made) == 349


def test_registered_chat_query(spark):
    got = {r.conv_id: r for r in queries.QUERIES["op2_chat_formatting"](spark, SF).collect()}
    r = got[-7]
    text = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.loss_chars) == (2, len(text))
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages_take_effect(spark, docs):
    texts, labels = invented(7, 60)
    base = " ".join(f"unique{i}" for i in range(60))
    passage = " ".join(f"passage{i}" for i in range(55))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first()
    extra = [(10_001, base), (10_002, base + " more"), (10_003, f"{base.replace('unique', 'first')} {passage}"), (10_004, f"{base.replace('unique', 'second')} {passage}"),
             (10_005, f"{base.replace('unique', 'third')} {bench.text}"), (10_006, None), (None, "a row without an id " * 3)]
    start = docs.unionByName(frame(spark, extra).select(*docs.columns))
    kept = {}
    now = start
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.stored(stage(spark, now, SF))
        kept[name] = now
        if name != "curve_packing":
            assert now.columns == corpus_pipeline.COLUMNS
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in kept.items()}
    assert {10_001, 10_002, 10_003, 10_004, 10_005, None} <= ids["toxicity"]
    assert 10_001 in ids["minhash_near_dedup"] and 10_002 not in ids["minhash_near_dedup"]
    after = {r.doc_id: r.text for r in kept["substring_dedup"].collect()}
    assert "passage3 " in after[10_003] and "passage" not in after[10_004] and after[10_004].startswith("second0 ")
    assert 10_005 in ids["substring_dedup"] and 10_005 not in ids["benchmark_decontamination"]
    assert ids["curve_packing"] == ids["benchmark_decontamination"]


def numbered(word, n=60):
    return " ".join(f"{word}{i}" for i in range(n))


def test_one_bad_row_takes_no_other_row_of_its_id_along(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    clean = [(None, numbered("a")), (None, numbered("b")), (5, numbered("c")), (6, numbered("d")), (6, None), (None, None)]
    start = frame(spark, clean + [(None, f"{numbered('e')} {bench}"), (6, f"{bench} {numbered('f')}")]).select(*docs.columns)
    rows = lambda df: sorted((repr(r.doc_id), repr(r.text)) for r in df.collect())
    want = sorted((repr(i), repr(t)) for i, t in clean)
    assert rows(corpus_pipeline.drop_benchmark_leaks(spark, start, SF)) == want
    start = frame(spark, clean + [(6, numbered("c") + " more")]).select(*docs.columns)
    assert rows(corpus_pipeline.drop_near_duplicates(spark, start, SF)) == want


def test_one_row_of_each_group_stays_whatever_the_ids(spark, docs):
    near = [(None, numbered("a") + f" end{i}") for i in range(4)]
    rows = near + [(None, numbered("b"))] * 3 + [(7, numbered("c"))] * 2 + [(7, numbered("d")), (8, numbered("d") + " more"), (7, numbered("d") + " end")]
    got = minhash.groups(frame(spark, near + rows[-3:])).collect()
    assert sorted((str(r.component_id), r.kept) for r in got) == [("7", False), ("7", False), ("7", True)] + [("None", False)] * 3 + [("None", True)]
    left = corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows).select(*docs.columns), SF).collect()
    assert sorted((str(r.doc_id), r.text[0]) for r in left) == [("7", "c"), ("7", "d"), ("None", "a"), ("None", "b")]


def test_pipeline_registration():
    assert corpus_pipeline.QUERIES["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "substring_dedup", "benchmark_decontamination", "curve_packing"]
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert minhash.PERCENT == 80 and minhash.SHINGLE == 5
