"""Centroid clustering of integer vectors, assigned by the threshold algorithm.

Every component x becomes floor(256 * x), so all sums and distances are exact. In each round the
centroids are sorted along every dimension, once. A vector's walk starts at its own value on each of
these lists and goes outward: every step takes from each list the nearest centroid not yet taken.
A centroid met for the first time gets its exact squared distance. One not met on any list is on
each at least as far as what the list gave last, so the sum of those squared gaps bounds all
centroids not met: as soon as it is strictly greater than the best exact distance, or no centroid
is left, the vector is done. (Strictly: one as near with a smaller number would win the tie.)

Each task walks its vectors in blocks, and sums the vectors of each cluster before anything is
shuffled: one row per task and cluster, so a cluster that holds a third of all vectors costs no
more than another. Centroids (k rows) are all that travels between rounds.

Defined results: vectors with another number of components, a null or a non-finite one are left
out; null and repeated ids stay, each row a vector of its own; null ids give no hash and start a
centroid only where too few others do (equal hashes: by components). Fewer vectors than centroids: each starts
one. Components beyond +-2**27 after scaling are taken as +-2**27, so that distances stay below
2**63. No vector at all gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kestrel.llm.common import stored

COMPONENTS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
LIMIT = 1 << 27
BLOCK = 512  # vectors walked at once

VECTORS = "id bigint, v array<bigint>"
ASSIGNED = "vec_id bigint, cluster int, distance bigint"


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """VECTORS of the rows whose vector has ``components`` components, none null or non-finite."""
    slim = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform("x", lambda c: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), c * F.lit(float(SCALE))))).cast("bigint"))
    return slim.filter(F.coalesce((F.size("x") == components) & finite, F.lit(False))).select("id", scaled.alias("v"))


def starts(vectors: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """(k, components): the vectors whose ids' hashes are smallest, in their order."""
    name = F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")).cast("binary"), 256)
    first = vectors.withColumn("h", name).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in first], dtype=np.int64)


class Walk:
    """The sorted lists of some centroids, and the walk of vectors along them."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.k, self.dims = centroids.shape
        self.order = np.argsort(centroids, axis=0, kind="stable")
        far = np.full((1, self.dims), 4 * LIMIT, dtype=np.int64)  # guards: farther than any centroid
        self.lists = np.concatenate([-far, np.take_along_axis(centroids, self.order, axis=0), far])
        self.names = np.concatenate([np.zeros((1, self.dims), np.int64), self.order, np.zeros((1, self.dims), np.int64)])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cluster, squared distance, steps taken) of every vector."""
        cluster, distance, steps = (np.zeros(len(vectors), dtype=np.int64) for _ in range(3))
        for a in range(0, len(vectors), BLOCK):
            cluster[a:a + BLOCK], distance[a:a + BLOCK], steps[a:a + BLOCK] = self._block(vectors[a:a + BLOCK])
        return cluster, distance, steps

    def _block(self, x: np.ndarray):
        n, dims = x.shape
        column = np.arange(dims)
        above = np.empty((n, dims), dtype=np.int64)  # next on each list, upwards and downwards
        for d in range(dims):
            above[:, d] = np.searchsorted(self.lists[1:-1, d], x[:, d]) + 1
        below = above - 1
        met = np.zeros((n, self.k), dtype=bool)
        best = np.full(n, np.iinfo(np.int64).max)
        which = np.zeros(n, dtype=np.int64)
        steps = np.zeros(n, dtype=np.int64)
        walking = np.arange(n)
        for step in range(self.k):
            up = self.lists[above[walking], column] - x[walking]
            down = x[walking] - self.lists[below[walking], column]
            rises = up < down
            taken = self.names[np.where(rises, above[walking], below[walking]), column]
            above[walking] += rises
            below[walking] -= ~rises
            fresh = np.zeros((len(walking), self.k), dtype=bool)
            np.put_along_axis(fresh, taken, True, axis=1)
            fresh &= ~met[walking]
            met[walking] |= fresh
            at, name = np.nonzero(fresh)
            if len(at):
                gap = x[walking[at]] - self.centroids[name]
                exact = np.full((len(walking), self.k), np.iinfo(np.int64).max)
                exact[at, name] = np.einsum("ij,ij->i", gap, gap)
                nearest = exact.argmin(axis=1)  # the smallest number of equally near ones
                value = exact[np.arange(len(walking)), nearest]
                held, held_which = best[walking], which[walking]
                better = (value < held) | ((value == held) & (nearest < held_which))
                best[walking] = np.where(better, value, held)
                which[walking] = np.where(better, nearest, held_which)
            steps[walking] = step + 1
            frontier = np.minimum(up, down)
            bound = np.einsum("ij,ij->i", frontier, frontier)
            walking = walking[(bound <= best[walking]) & ~met[walking].all(axis=1)]
            if not len(walking):
                break
        return which, best, steps


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _sums(centroids: np.ndarray):
    """mapInArrow body over VECTORS: (cluster, n, sums) of the clusters a task has met."""
    walk = Walk(centroids)

    def run(batches):
        total = np.zeros(centroids.shape, dtype=np.int64)
        count = np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(1), walk.dims)
                cluster = walk.nearest(vectors)[0]
                order = np.argsort(cluster, kind="stable")
                met, first = np.unique(cluster[order], return_index=True)
                total[met] += np.add.reduceat(vectors[order], first, axis=0)
                count += np.bincount(cluster, minlength=walk.k)
        some = np.flatnonzero(count)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]),
                                              pa.array([row.tolist() for row in total[some]], pa.list_(pa.int64()))], names=["cluster", "n", "sums"])
    return run


def _assign(centroids: np.ndarray):
    walk = Walk(centroids)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cluster, distance, _ = walk.nearest(_matrix(batch.column(1), walk.dims))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                                 names=["vec_id", "cluster", "distance"])
    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: each cluster's floored means; an empty one stays."""
    sums = vectors.mapInArrow(_sums(centroids), "cluster int, n bigint, sums array<bigint>")
    # exact beyond 64 bits; k rows of components reach the driver
    each = sums.select("cluster", "n", F.posexplode("sums").alias("d", "s"))
    rows = each.groupBy("cluster", "d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()
    out = centroids.copy()
    for r in rows:
        out[r["cluster"], r["d"]] = int(r["s"]) // r["n"]
    return out


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def cluster(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
            components: int = COMPONENTS) -> tuple[DataFrame, np.ndarray]:
    """(ASSIGNED rows after ``rounds`` rounds, the final centroids)."""
    vectors = stored(integer_vectors(table, id_col, vector_col, components))
    centroids = starts(vectors, k)
    if not len(centroids):
        return vectors.selectExpr("id as vec_id", "cast(null as int) as cluster", "cast(null as bigint) as distance"), centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return stored(vectors.mapInArrow(_assign(centroids), ASSIGNED)), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """assigned and its cluster's inertia, the whole inertia, and its centroid's digest."""
    rows = assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # k rows
    named = [(r["cluster"], int(r["s"]), digest(centroids[r["cluster"]])) for r in rows]
    per = assigned.sparkSession.createDataFrame(named, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    whole = sum(s for _, s, _ in named)
    return (assigned.join(F.broadcast(per), "cluster").withColumn("inertia", F.lit(whole).cast("bigint"))  # k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
