"""Ward's linkage and the Euclidean silhouette against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import silhouette as SI
from kestrel.operators import ward as W


def brute_ward(points, k):
    """Partition after merging, step by step, the two clusters whose union costs least."""
    clusters = [[i] for i in range(len(points))]
    while len(clusters) > k:
        n = np.array([len(c) for c in clusters], dtype=float)
        mean = np.array([points[c].mean(axis=0) for c in clusters])
        cost = n[:, None] * n / (n[:, None] + n) * ((mean[:, None, :] - mean[None]) ** 2).sum(axis=2)
        cost[np.tril_indices(len(n))] = np.inf
        i, j = np.unravel_index(cost.argmin(), cost.shape)
        clusters[i] += clusters.pop(j)
    return {frozenset(c) for c in clusters}


def partition(labels):
    groups = {}
    for i, c in enumerate(labels):
        groups.setdefault(c, []).append(i)
    return {frozenset(g) for g in groups.values()}


def blobs(seed, n, dims, centres):
    rng = np.random.default_rng(seed)
    at = rng.normal(0, 6, (centres, dims))
    return at[rng.integers(0, centres, n)] + rng.normal(0, 1, (n, dims))


def frame(spark, points, parts=4):
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    cols = [f"x{j}" for j in range(len(points[0]))]
    return spark.createDataFrame(rows, "i bigint, " + ", ".join(f"{c} double" for c in cols)).repartition(parts), cols


@pytest.mark.parametrize("seed,n,dims,k", [(1, 60, 2, 3), (2, 150, 4, 5), (3, 200, 1, 7), (4, 90, 3, 1)])
def test_ward_equals_brute_force(spark, seed, n, dims, k):
    points = blobs(seed, n, dims, 6)
    df, cols = frame(spark, points)
    got = {r.i: r.ward_cluster for r in W.ward_clusters(df, cols, k).collect()}
    assert partition([got[i] for i in range(n)]) == brute_ward(points, k)


def test_ward_of_500_points(spark):
    points = blobs(11, 500, 4, 8)
    df, cols = frame(spark, points, 7)
    got = {r.i: r.ward_cluster for r in W.ward_clusters(df, cols, 8).collect()}
    assert partition([got[i] for i in range(500)]) == brute_ward(points, 8)


def test_linkage_costs_never_fall_and_add_up():
    points = blobs(5, 120, 3, 4)
    merges = W.linkage(np.ones(120), points)
    costs = [m[2] for m in merges]
    assert len(merges) == 119 and costs == sorted(costs)
    # all merges together add up to the whole sum of squares
    assert math.isclose(sum(costs), float(((points - points.mean(axis=0)) ** 2).sum()), rel_tol=1e-9)


def test_a_full_tree_keeps_counts_means_and_deviations():
    points = blobs(6, 3000, 3, 5)
    tree = W.CFTree(3, 100)
    for p in points:
        tree.insert(1.0, p, 0.0)
    n, mean, dev = tree.rows()
    assert len(n) <= 100 and n.sum() == 3000
    assert np.allclose((n[:, None] * mean).sum(axis=0) / 3000, points.mean(axis=0))
    whole = ((points - points.mean(axis=0)) ** 2).sum()
    assert math.isclose(dev.sum() + (n * ((mean - points.mean(axis=0)) ** 2).sum(axis=1)).sum(), whole, rel_tol=1e-9)


def test_more_points_than_features_find_separate_blobs(spark, monkeypatch):
    monkeypatch.setattr(W, "MERGE_FAN", 2)
    rng = np.random.default_rng(8)
    truth = rng.integers(0, 4, 1500)
    points = np.array([[0, 0], [30, 0], [0, 30], [30, 30]])[truth] + rng.normal(0, 1, (1500, 2))
    df, cols = frame(spark, points, 6)
    got = {r.i: r.ward_cluster for r in W.ward_clusters(df, cols, 4, max_features=60).collect()}
    assert partition([got[i] for i in range(1500)]) == partition(truth.tolist())


def test_ward_defined_results(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0), (3, None, 1.0), (4, float("nan"), 1.0), (5, 9.0, 9.0)], "i int, x double, part double")
    got = {r.i: r.ward_cluster for r in W.ward_clusters(df, ["x", "part"], 3).collect()}
    assert got == {1: 0, 2: 0, 3: None, 4: None, 5: 1}  # two distinct points: two clusters
    assert W.ward_clusters(df.limit(0), ["x", "part"], 3).collect() == []


def brute_silhouette(points, labels):
    d = np.sqrt(((points[:, None, :] - points[None]) ** 2).sum(axis=2))
    out = []
    for i, c in enumerate(labels):
        own = [j for j, o in enumerate(labels) if o == c]
        if len(own) == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (len(own) - 1)
        b = min(d[i, [j for j, o in enumerate(labels) if o == x]].mean() for x in set(labels) - {c})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


@pytest.mark.parametrize("seed,n,clusters,block", [(1, 80, 3, 4096), (2, 150, 12, 16)])
def test_silhouette_equals_all_pairs(spark, monkeypatch, seed, n, clusters, block):
    if block < 100:
        monkeypatch.setattr(SI, "CLUSTERS", 5)  # several blocks of clusters
    rng = random.Random(seed)
    points = blobs(seed, n, 3, clusters)
    labels = [rng.choice("abcdefghijkl"[:clusters]) if rng.random() < 0.2 else "abcdefghijkl"[int(p[0] > 0)] for p in points]
    labels[0] = "alone"
    df, cols = frame(spark, points)
    named = df.join(spark.createDataFrame(list(enumerate(labels)), "i bigint, c string"), "i")
    assert math.isclose(SI.silhouette(named, cols, "c", block).first()[0], brute_silhouette(points, labels), rel_tol=1e-9)


def test_sums_of_a_block_hold_far_from_zero_and_for_copies_and_close_pairs():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(700, 5)), rng.normal(size=(1500, 5))
    y[:40], y[40:80], y[80:400] = x[:40], x[40:80] + 1e-9, x[0]  # copies, and pairs a product would cancel
    x[-1] = 1e4  # a long vector must not spoil the others' sums
    for shift in (0.0, 1e6):
        got = SI.block_sums(x + shift, y + shift)
        gap = (x + shift)[:, None, :] - (y + shift)[None]
        assert np.allclose(got, np.sqrt((gap * gap).sum(axis=2)).sum(axis=1), rtol=1e-12, atol=0)
    assert SI.block_sums(y[80:400], y[80:400]).max() == 0.0
    gap = x[40:80] - y[40:80]  # single pairs: no small distance is lost in a large sum
    assert np.allclose([SI.block_sums(x[i:i + 1], y[i:i + 1])[0] for i in range(40, 80)], np.sqrt((gap * gap).sum(axis=1)), rtol=1e-9, atol=0)
    pair = np.array([x[40], np.full(5, 1e120)])  # a close pair beside a vector whose square is huge
    assert math.isclose(SI.block_sums(y[40:41], pair)[0], SI.block_sums(y[40:41], pair[1:])[0], rel_tol=1e-12)


def test_rows_of_a_block_follow_the_width_of_the_vectors(spark, monkeypatch):
    monkeypatch.setattr(SI, "BLOCK", 60)
    rng = random.Random(4)
    points, labels = blobs(4, 90, 3, 2), [rng.choice("ab") for _ in range(90)]
    df, cols = frame(spark, points)
    named = df.join(spark.createDataFrame(list(enumerate(labels)), "i bigint, c string"), "i")
    seen = []
    plain = F.ceil
    monkeypatch.setattr(SI.F, "ceil", lambda c: (seen.append(str(c)), plain(c))[1])
    assert math.isclose(SI.silhouette(named, cols, "c").first()[0], brute_silhouette(points, labels), rel_tol=1e-9)
    assert seen and all("20" in c for c in seen)  # 60 numbers, three a row


def test_bounds_leave_far_clusters_out(spark):
    points = np.concatenate([blobs(1, 40, 2, 1) * 0.01 + [100 * i, 0] for i in range(6)])
    df, cols = frame(spark, points)
    named = df.withColumn("c", (F.col("i") / 40).cast("int"))
    asked = SI.wanted_clusters(SI._points(named, cols, "c"))
    assert asked.count() < 240 * 4  # own cluster and its one or two neighbours, not all six


def test_silhouette_defined_results(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 1), (None, 1), (5.0, None)], "x double, c int")
    assert SI.silhouette(df, ["x"], "c").first()[0] is None  # one cluster
    df = spark.createDataFrame([(0.0, 1), (0.0, 1), (0.0, 2), (0.0, 2)], "x double, c int")
    assert SI.silhouette(df, ["x"], "c").first()[0] == 0.0
    assert SI.silhouette(df.limit(0), ["x"], "c").first()[0] is None
