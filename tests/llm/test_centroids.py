"""Centroid clustering: the walk against all distances, whole rounds against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from kestrel.llm import centroids as ce

from llm_rows import shipped  # noqa: F401 (fixtures)

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster int, distance string, v array<int>, x int"


def nearest(x, c):
    d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


@pytest.mark.parametrize("spread", [1, 3, 300, 1 << 20, ce.LIMIT])
def test_walk_finds_the_nearest_with_the_smaller_number(spread):
    rng = np.random.default_rng(spread)
    c = rng.integers(-spread, spread + 1, (40, 8))
    c[7] = c[3]  # equal centroids: the smaller number wins
    x = np.concatenate([rng.integers(-spread, spread + 1, (1500, 8)), c, c + 1])
    which, distance, steps = ce.Walk(c).nearest(x)
    want, least = nearest(x, c)
    assert (which == want).all() and (distance == least).all() and (which != 7).all()
    assert steps.max() <= 40


def test_walk_stops_before_it_has_met_every_centroid():
    rng = np.random.default_rng(1)
    c = rng.integers(-1000, 1000, (40, 2))
    steps = ce.Walk(c).nearest(c[rng.integers(0, 40, 2000)] + rng.integers(-2, 3, (2000, 2)))[2]
    assert np.median(steps) <= 3


def brute(rows, k, rounds, components):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == components and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    named = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    c = np.array([v for _, v in named[:k]], dtype=object)
    x = np.array([v for _, v in kept], dtype=object)
    for _ in range(rounds):
        which, _ = nearest(x, c)
        for j in range(len(c)):
            if (which == j).any():
                c[j] = [int(s) // int((which == j).sum()) for s in x[which == j].sum(axis=0)]
    which, d = nearest(x, c)
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c]
    return sorted(((i, int(w), int(y), int(d[which == w].sum()), int(d.sum()), digests[w]) for (i, _), w, y in zip(kept, which, d)), key=str)


def clustered(spark, rows, **more):
    table = spark.createDataFrame([(i, v, 0, 1, "d", [1], 2) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in ce.with_inertia(*ce.cluster(table, **more)).collect()), key=str)


def test_rounds_match_plain_integers(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(200), [rng.gauss(0, 1) for _ in range(6)]) for _ in range(300)]
    rows += [(500 + i, [0.5] * 6) for i in range(150)]  # a third alike
    rows += [(1, None), (2, []), (3, [1.0] * 5), (4, [None] + [0.1] * 5), (5, [float("nan")] + [0.1] * 5), (6, [float("inf")] + [0.1] * 5),
             (7, [1e4] * 6), (8, [-1e4] * 6), (None, [0.25] * 6), (None, [0.25] * 6)]
    assert clustered(spark, rows, k=12, components=6) == brute(rows, 12, ce.ROUNDS, 6)


def test_fewer_vectors_than_centroids_none_and_an_empty_table(spark):
    rows = [(i, [float(i), -0.001]) for i in range(5)]
    assert clustered(spark, rows, components=2) == brute(rows, 40, ce.ROUNDS, 2)
    assert clustered(spark, [(1, None)], components=2) == []
    assert clustered(spark, [], components=2) == []


def test_huge_components_are_taken_as_the_limit(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.0])]
    got = clustered(spark, rows, components=2, k=1)
    assert len(got) == 3 and all(r[2] >= 0 for r in got)
