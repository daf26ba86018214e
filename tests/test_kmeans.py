"""Fits made together: as good as single ones, and no more passes for more of them."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kestrel.operators import kmeans as KM
from kestrel.session import cut_lineage


def vectors(spark, points):
    df = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(points)], "i bigint, v array<double>")
    return cut_lineage(df.repartition(5).withColumn("features", array_to_vector(F.col("v"))))


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(2)
    return rng.normal(0, 8, (5, 3))[rng.integers(0, 5, 400)] + rng.normal(0, 0.4, (400, 3))


def test_every_fit_is_a_fixed_point_with_its_own_cost(spark, blobs):
    fits = KM.fit_many(vectors(spark, blobs), [2, 5], [1, 2, 3])
    assert set(fits) == {(k, s) for k in (2, 5) for s in (1, 2, 3)}
    for (k, _), fit in fits.items():
        d2 = ((blobs[:, None, :] - fit.centres[None]) ** 2).sum(axis=2)
        assert fit.cost == pytest.approx(d2.min(axis=1).sum(), rel=1e-9)
        for c in range(k):
            assert np.allclose(fit.centres[c], blobs[d2.argmin(axis=1) == c].mean(axis=0), atol=1e-5)
    best = KM.best_of(fits, 5)
    assert best.cost < 400 * 3 * 0.4 ** 2 * 1.3  # the five blobs
    labels = {r.i: r.raw_cluster for r in best.transform(vectors(spark, blobs)).collect()}
    assert [labels[i] for i in range(400)] == ((blobs[:, None, :] - best.centres[None]) ** 2).sum(axis=2).argmin(axis=1).tolist()


def test_more_seeds_and_ks_take_no_more_passes(spark, blobs, monkeypatch):
    passes = []
    real = KM._pass
    monkeypatch.setattr(KM, "_pass", lambda *a: passes.append(1) or real(*a))
    points = vectors(spark, blobs)
    fits = KM.fit_many(points, [5], [1])
    one = len(passes)
    passes.clear()
    KM.fit_many(points, [2, 3, 4, 5], list(range(1, 9)))
    assert len(passes) <= one + 25  # 32 fits: only the slowest one's steps count
    assert fits[(5, 1)].cost > 0


def test_few_and_equal_points(spark):
    fits = KM.fit_many(vectors(spark, [[1, 1]] * 30 + [[2, 2]]), [3], [7])
    fit = fits[(3, 7)]
    assert fit.cost == 0 and len(fit.centres) == 3
    assert len({r.raw_cluster for r in fit.transform(vectors(spark, [[1, 1], [2, 2]])).collect()}) == 2
    with pytest.raises(ValueError):
        KM.fit_many(vectors(spark, [[1, 1]]).limit(0), [2], [1])
