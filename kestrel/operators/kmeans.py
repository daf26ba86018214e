"""Many k-means fits over the same points at once: every seed and every k in one pass per iteration.

Seeding is k-means||: a few rounds draw points with a chance that grows with their squared distance to what
has been drawn, each seed for itself; the candidates, weighted by the points nearest to them, are reduced to k
by weighted k-means++ on the driver (their number follows from k and the rounds, not from the data). Then all fits
take Lloyd steps together: a task assigns its points for every fit that still moves and sends one row per (fit,
cluster), whatever its number of points. So passes over the data are the rounds plus the steps of the slowest
fit; they don't grow with the number of seeds times the number of ks.

Draws are hashes of the point and the seed: they are the same however the points are partitioned.
Sums of floats may differ in their last bits between partitionings.

Defined results: points with a null component are the caller's to drop; fewer distinct points than k leave
clusters empty, whose centres stay where they were drawn; an empty frame raises.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROUNDS = 4        # of drawing candidates
OVERSAMPLING = 3  # candidates drawn a round, in expectation, for each of the k clusters
TOLERANCE = 1e-6


class Fitted:
    """A fit's centres; ``transform`` labels rows of any frame with the same vector column."""

    def __init__(self, centres: np.ndarray, cost: float, features: str, column: str):
        self.centres, self.cost, self.features, self.column = centres, cost, features, column

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, frame: DataFrame) -> DataFrame:
        point = vector_to_array(F.col(self.features))
        centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in self.centres])
        gaps = F.transform(centres, lambda c: F.aggregate(F.zip_with(c, point, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda a, b: a + b))
        return frame.withColumn(self.column, (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int"))


def _draw(seed: int, turn: int) -> Column:
    """A number in [0, 1) from the point, the seed and the turn."""
    return F.pmod(F.xxhash64("__v", F.lit(seed), F.lit(turn)), F.lit(1 << 40)) / float(1 << 40)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centre, squared distance to it) of every row."""
    which = ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
    gap = x - centres[which]
    return which, (gap * gap).sum(axis=1)


def _summed(fits: dict[int, np.ndarray], with_sums: bool):
    """mapInPandas body: per fit and cluster the number of points, their distances' sum and, if asked, the points' sum."""
    def run(batches):
        count = {f: np.zeros(len(c)) for f, c in fits.items()}
        cost = {f: np.zeros(len(c)) for f, c in fits.items()}
        total = {f: np.zeros_like(c) for f, c in fits.items()}
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["__v"].to_numpy())
            for f, centres in fits.items():
                which, d2 = _nearest(x, centres)
                count[f] += np.bincount(which, minlength=len(centres))
                cost[f] += np.bincount(which, weights=d2, minlength=len(centres))
                if with_sums:
                    one = np.zeros((len(centres), len(x)))
                    one[which, np.arange(len(x))] = 1
                    total[f] += one @ x
        rows = [(f, int(c), count[f][c], cost[f][c], total[f][c].tolist() if with_sums else []) for f in fits for c in np.flatnonzero(count[f])]
        if rows:
            yield pd.DataFrame(rows, columns=["fit", "cluster", "n", "cost", "sums"])
    return run


def _pass(points: DataFrame, fits: dict[int, np.ndarray], with_sums: bool):
    """(n, cost, sums) arrays of every fit, by cluster. What reaches the driver has a row per fit, cluster and dimension."""
    each = points.mapInPandas(_summed(fits, with_sums), "fit int, cluster int, n double, cost double, sums array<double>")
    out = {f: (np.zeros(len(c)), np.zeros(len(c)), np.zeros_like(c)) for f, c in fits.items()}
    values = F.concat(F.array("n", "cost"), "sums")
    for r in each.select("fit", "cluster", F.posexplode(values).alias("i", "x")).groupBy("fit", "cluster", "i").agg(F.sum("x").alias("x")).collect():
        n, cost, sums = out[r["fit"]]
        if r["i"] == 0:
            n[r["cluster"]] = r["x"]
        elif r["i"] == 1:
            cost[r["cluster"]] = r["x"]
        else:
            sums[r["cluster"], r["i"] - 2] = r["x"]
    return out


def _drawn(chosen: dict[int, np.ndarray], chances: dict[int, float], turn: int):
    """mapInPandas body: (seed, point) of the points drawn; the draws are columns of the batch."""
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["__v"].to_numpy())
            for seed, centres in chosen.items():
                d2 = _nearest(x, centres)[1]
                hit = batch[f"__u{seed}"].to_numpy() < np.minimum(chances[seed] * d2, 1.0)
                if (hit & (d2 > 0)).any():
                    found = np.unique(x[hit & (d2 > 0)], axis=0)
                    yield pd.DataFrame({"seed": np.full(len(found), seed, dtype=np.int64), "v": list(found)})
    return run


def _candidates(points: DataFrame, k: int, seeds: list[int]) -> dict[int, np.ndarray]:
    """k-means||: candidate centres of every seed."""
    first = points.agg(*[F.min_by("__v", _draw(s, 0)).alias(f"v{s}") for s in seeds]).first()
    if first[f"v{seeds[0]}"] is None:
        raise ValueError("no points to cluster")
    chosen = {s: np.array([first[f"v{s}"]], dtype=float) for s in seeds}
    for turn in range(1, ROUNDS + 1):
        costs = {s: cost.sum() for s, (_, cost, _) in _pass(points, chosen, False).items()}
        moving = {s: c for s, c in chosen.items() if costs[s] > 0}
        if not moving:
            break
        chances = {s: OVERSAMPLING * k / costs[s] for s in moving}
        drawn = points.select("__v", *[_draw(s, turn).alias(f"__u{s}") for s in moving]).mapInPandas(_drawn(moving, chances, turn), "seed bigint, v array<double>")
        for r in drawn.distinct().collect():  # OVERSAMPLING * k of a seed, in expectation
            chosen[r["seed"]] = np.concatenate([chosen[r["seed"]], [r["v"]]])
    return {s: np.unique(c, axis=0) for s, c in chosen.items()}


def _reduced(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Weighted k-means++ over the candidates, each centre the best of a few draws."""
    rng = np.random.default_rng([seed, k])
    weights = np.maximum(weights, 1e-9)
    centres = [candidates[rng.choice(len(candidates), p=weights / weights.sum())]]
    d2 = ((candidates - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k:
        mass = weights * d2
        if mass.sum() <= 0:  # fewer distinct points than k
            centres.append(candidates[len(centres) % len(candidates)])
            continue
        tries = rng.choice(len(candidates), size=2 + int(np.log(k)), p=mass / mass.sum())
        after = [np.minimum(d2, ((candidates - candidates[t]) ** 2).sum(axis=1)) for t in tries]
        best = int(np.argmin([(weights * a).sum() for a in after]))
        centres.append(candidates[tries[best]])
        d2 = after[best]
    return np.array(centres)


def fit_many(vectors: DataFrame, ks: list[int], seeds: list[int], features: str = "features", max_iter: int = 300, column: str = "raw_cluster") -> dict[tuple[int, int], Fitted]:
    """A fit for every k and seed. ``vectors`` should be written (it is read once per step)."""
    points = vectors.select(vector_to_array(F.col(features)).alias("__v"))
    seeds, ks = list(dict.fromkeys(seeds)), list(dict.fromkeys(ks))
    candidates = _candidates(points, max(ks), seeds)
    weights = {s: n for s, (n, _, _) in _pass(points, candidates, False).items()}
    names = [(k, s) for k in ks for s in seeds]
    centres = {i: _reduced(candidates[s], weights[s], k, s) for i, (k, s) in enumerate(names)}
    moving = dict(centres)
    for _ in range(max_iter):
        if not moving:
            break
        for f, (n, _, sums) in _pass(points, moving, True).items():
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], moving[f])
            shift = ((new - moving[f]) ** 2).sum(axis=1).max()
            centres[f] = moving[f] = new
            if shift <= TOLERANCE ** 2:
                del moving[f]
    costs = _pass(points, centres, False)
    return {name: Fitted(centres[i], float(costs[i][1].sum()), features, column) for i, name in enumerate(names)}


def best_of(fits: dict[tuple[int, int], Fitted], k: int) -> Fitted:
    """The fit of k with the lowest cost, the earliest seed's on a tie."""
    return min((fit for (own, _), fit in fits.items() if own == k), key=lambda fit: fit.cost)
