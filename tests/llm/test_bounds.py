"""Long and repetitive texts stay cheap; training excerpts cover whole texts; clashing columns."""

import random
import resource
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kestrel.llm import decontam, licenses
from kestrel.llm.common import excerpts

from llm_rows import SF, docs, frame, shipped  # noqa: F401 (fixtures)


def seeds(text, k=5):
    data = np.frombuffer(text.encode(), np.uint8)
    found, _, at, _ = decontam.seeds_of(data, np.array([0, len(data)]), k)
    return at, found


def test_tiling_a_million_tokens_of_runs_needs_little_memory():
    rng = random.Random(1)
    item = "0 1 " * 300 + " ".join(rng.choice("abcdef") for _ in range(400))
    doc = "0 1 " * 450_000 + " ".join(rng.choice("abcdef") for _ in range(100_000))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    began = time.process_time()
    tiles = decontam.tile(*seeds(doc), *seeds(item), 5)
    assert sum(t[2] for t in tiles) >= 600 and tiles[0] == (0, 0, 600)
    assert time.process_time() - began < 60
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 800_000  # kB


def test_both_ways_of_tiling_agree(monkeypatch):
    rng = random.Random(9)
    for _ in range(150):
        words = "abcd" if rng.random() < 0.5 else "abcdefghijkl"
        doc, item = (" ".join(rng.choice(words) for _ in range(rng.randint(0, 70))) for _ in range(2))
        if rng.random() < 0.5 and doc:
            item = doc[10:60].strip() + " " + item
        a, b = seeds(doc, 3), seeds(item, 3)
        monkeypatch.setattr(decontam, "LISTED_MATCHES", 1 << 14)
        listed = decontam.tile(*a, *b, 3)
        monkeypatch.setattr(decontam, "LISTED_MATCHES", -1)
        assert decontam.tile(*a, *b, 3) == listed


def test_a_licence_phrase_repeated_throughout_a_long_text(spark):
    n = 300_000  # 2.7 MB
    row = licenses.scan(frame(spark, [(1, "cc by nc " * n), (2, "cc by " * n)])).select("id", "n_base", "first_word", "last_word", "labels").collect()
    assert sorted(tuple(r) for r in row) == [(1, n, 0, 3 * (n - 1), "cc-by-nc"), (2, 0, None, None, "")]


def test_excerpts_cover_the_whole_text(spark):
    words = [f"w{i}" for i in range(20_000)]
    rows = [(1, " ".join(words)), (2, "short text"), (3, ""), (4, None), (5, "x" * 50_000)]
    got = {r.id: r.e for r in frame(spark, rows).select(F.col("doc_id").alias("id"), excerpts(F.col("text"), 4000).alias("e")).collect()}
    assert got[2] == "short text" and got[3] == "" and got[4] is None and 3000 < len(got[5]) <= 4100
    taken = got[1].split()
    assert set(taken) <= set(words) and 3000 < len(got[1]) <= 4100
    places = [int(w[1:]) for w in taken]
    assert places == sorted(places) and places[0] < 300 and places[-1] > 19_700
    assert max(np.diff(places)) < 4000


def test_the_pipelines_first_stage_takes_a_column_named_score(spark, docs):
    named = docs.limit(40).withColumn("score", F.lit("x")).withColumn("id", F.lit(1))
    out = corpus_pipeline.drop_toxic(spark, named, SF)
    assert out.columns == corpus_pipeline.COLUMNS and out.count() <= 40
