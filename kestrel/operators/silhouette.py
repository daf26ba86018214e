"""The silhouette with plain Euclidean distances, exact, for any number of points.

A point's value needs its mean distance to its own cluster and to the nearest other one. Which
others can be nearest follows from the clusters' centroids: a mean distance is at least the distance to
the centroid and at most the root of the mean squared distance, so only clusters whose lower bound is not above
the least upper bound are looked at. For those, sums of distances are taken over all pairs, in blocks: a
cluster's members are dealt into blocks of rows, so are the points that ask for it, and each
(asking block, member block) is one task's work and gives one partial sum per asking point. Squared
distances of a tile of pairs are one matrix product of centred vectors; pairs so close that the product
would cancel are taken from their differences.

Cost: every point is compared with all members of its own cluster and of the few that may be
nearest, so the work grows with the square of the clusters' sizes; rows shuffled grow with points *
members / block. A block holds BLOCK numbers, whatever the width of a vector, so a task's memory is
bounded. Nothing is sampled. For very large frames use ``ml.silhouette_sq``, which is linear.

Defined results: as the mean over all points; a cluster's only point counts 0; fewer than two
clusters give null; points with a null or non-finite component, or without a label, are left out.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 21   # numbers in the points, or members, of a cell
ROWS = 1 << 15    # points, or members, of a cell at most
TILE = 512        # asking points, and twice as many members, of one matrix product
CLOSE = 1e-4      # share of the squared lengths below which a product's squared distance is taken anew
CELL_TASKS = 8192
CLUSTERS = 1024   # whose bounds are taken at once


def _sqdist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, x: s + x)


def _points(frame: DataFrame, features: list[str] | str, cluster: str) -> DataFrame:
    arr = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(*[F.col(f).cast("double") for f in features])
    finite = F.forall(arr, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return frame.where(finite & F.col(cluster).isNotNull()).select(F.col(cluster).alias("c"), arr.alias("v")).withColumn("p", F.monotonically_increasing_id())


def wanted_clusters(points: DataFrame) -> DataFrame:
    """(p, c, v, want): the clusters whose distances a point needs, its own among them."""
    stats = points.groupBy("c").agg(F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.mean(array_to_vector(F.col("v")))).alias("m"))
    spread = points.join(stats, "c").groupBy("c").agg(F.avg(_sqdist(F.col("v"), F.col("m"))).alias("var"))
    stats = cut_lineage(stats.join(spread, "c"))  # one row per cluster
    n_blocks = -(-stats.count() // CLUSTERS) or 1
    packed = (stats.withColumn("k", F.pmod(F.xxhash64("c"), F.lit(n_blocks))).groupBy("k")
              .agg(F.collect_list(F.struct(F.col("c").alias("want"), "m", "var")).alias("all")))  # about CLUSTERS a row
    met = points.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))
    met = met.join(F.broadcast(packed) if n_blocks == 1 else packed, "k")  # one row: CLUSTERS centroids at most
    others = F.filter("all", lambda o: o["want"] != F.col("c"))
    bounds = F.transform(others, lambda o: F.struct(o["want"].alias("want"), _sqdist(F.col("v"), o["m"]).alias("d2"), o["var"].alias("var")))
    bounded = met.select("p", "c", "v", bounds.alias("bounds")).withColumn("least", F.array_min(F.transform("bounds", lambda o: o["d2"] + o["var"])))
    # a hair of slack for rounding: a cluster too many costs time, one too few would be wrong
    near = F.filter("bounds", lambda o: o["d2"] <= F.col("least") * (1 + 1e-9))
    rows = bounded.select("p", "c", "v", "least", F.explode(near).alias("o")).select("p", "c", "v", "least", "o.want", "o.d2")
    if n_blocks > 1:  # the least bound of all blocks
        rows = rows.drop("least").join(bounded.groupBy("p").agg(F.min("least").alias("least")), "p").where(F.col("d2") <= F.col("least") * (1 + 1e-9))
    return points.select("p", "c", "v", F.col("c").alias("want")).unionByName(rows.select("p", "c", "v", "want"))


def _tile(x: np.ndarray, y: np.ndarray, d2: np.ndarray, squares: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Distances of a tile from its products; close pairs, and those that are no numbers, from differences."""
    close = ~(d2 > CLOSE * (squares.max() + other.max()))
    if close.any():
        a, b = np.nonzero(close & ~(d2 > CLOSE * (squares[:, None] + other)))
        step = max(1, (1 << 18) // x.shape[1])
        for k in range(0, len(a), step):
            i, j = a[k:k + step], b[k:k + step]
            gap = x[i] - y[j]
            d2[i, j] = np.einsum("ij,ij->i", gap, gap)
    return np.sqrt(d2, out=d2)


def _distinct(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows of v, how often each occurs, and which of them each row of v is."""
    codes, _ = pd.factorize(np.array([row.tobytes() for row in v], dtype=object))
    _, first, counts = np.unique(codes, return_index=True, return_counts=True)
    return v[first], counts.astype(np.float64), codes


def block_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each row of x the sum of its Euclidean distances to all rows of y."""
    (x, _, place), (y, times, _) = _distinct(x), _distinct(y)
    total = np.zeros(len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        centre = y.mean(axis=0)  # no distance changes, and shorter vectors cancel less
        u, w = x - centre, y - centre
        squares, other = (u * u).sum(axis=1), (w * w).sum(axis=1)
        left = np.column_stack([-2 * u, squares, np.ones(len(u))])
        right = np.column_stack([w, np.ones(len(w)), other])
        for j in range(0, len(y), 2 * TILE):
            cols = slice(j, j + 2 * TILE)
            turned = np.ascontiguousarray(right[cols].T)
            for i in range(0, len(x), TILE):
                rows = slice(i, i + TILE)
                total[rows] += _tile(x[rows], y[cols], left[rows] @ turned, squares[rows], other[cols]) @ times[cols]
    return total[place]


def _cell_sums():
    def run(batches):
        """Rows sorted by cell: asking points and members of one cluster's block pair -> (p, want, s)."""
        held = None
        for batch in [*batches, None]:
            if batch is not None:
                held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if held is None or not len(held):
                continue
            key = held["cell"].to_numpy()
            edges = np.append(0, np.flatnonzero(key[1:] != key[:-1]) + 1)
            edges = np.append(edges, len(key)) if batch is None else edges  # the last cell may go on
            for a, b in zip(edges[:-1], edges[1:]):
                rows = held.iloc[a:b]
                asks = rows["p"].notna().to_numpy()
                if asks.all() or not asks.any():
                    continue
                x, y = (np.stack(rows["v"].to_numpy()[which]) for which in (asks, ~asks))
                yield pd.DataFrame({"p": rows["p"].to_numpy()[asks].astype(np.int64), "want": rows["want"].iloc[0], "s": block_sums(x, y)})
            held = held.iloc[edges[-1]:]
    return run


def distance_sums(points: DataFrame, block: int | None = None) -> DataFrame:
    """(p, want, s): the sum of a point's distances to all members of each cluster it needs. ``block``: rows
    of a block, by default as many as hold BLOCK numbers."""
    asked = cut_lineage(wanted_clusters(points).select("p", "c", "want"))
    block = block or min(ROWS, max(1, BLOCK // (points.agg(F.max(F.size("v"))).first()[0] or 1)))
    sizes = cut_lineage(asked.groupBy("want").agg(F.count(F.lit(1)).alias("n_ask"), F.count_if(F.col("c") == F.col("want")).alias("n"))
                        .select("want", F.ceil(F.col("n_ask") / block).alias("a_blocks"), F.ceil(F.col("n") / block).alias("m_blocks")))
    asks = (asked.select("p", "want").join(points.select("p", "v"), "p").join(sizes, "want").withColumn("i", F.pmod(F.xxhash64("p"), F.col("a_blocks")))
            .select("want", "p", "v", "i", F.explode(F.expr("sequence(0L, m_blocks - 1)")).alias("j")))
    members = (points.withColumnRenamed("c", "want").join(sizes, "want").withColumn("j", F.pmod(F.xxhash64("p"), F.col("m_blocks")))
               .select("want", F.lit(None).cast("bigint").alias("p"), "v", F.explode(F.expr("sequence(0L, a_blocks - 1)")).alias("i"), "j"))
    cells = asks.unionByName(members).withColumn("cell", F.concat_ws("/", F.col("want").cast("string"), "i", "j"))
    n_cells = sizes.agg(F.sum(F.col("a_blocks") * F.col("m_blocks"))).first()[0] or 1
    n = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(n_cells, CELL_TASKS))
    want_type = points.schema["c"].dataType.simpleString()
    parts = (cells.repartition(n, "cell").sortWithinPartitions("cell").select("cell", "want", "p", "v")
             .mapInPandas(_cell_sums(), f"p bigint, want {want_type}, s double"))
    return parts.groupBy("p", "want").agg(F.sum("s").alias("s"))


def point_silhouettes(frame: DataFrame, features: list[str] | str, cluster: str, block: int | None = None) -> DataFrame:
    """(c, a, b, s) per point: its cluster, mean distance to it and to the nearest other, and its silhouette."""
    points = cut_lineage(_points(frame, features, cluster))  # the numbers of points must not change between uses
    n = points.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    mean = (distance_sums(points, block).join(points.select("p", "c"), "p").join(n.withColumnRenamed("c", "want"), "want")
            .withColumn("own", F.col("c") == F.col("want")))
    each = mean.groupBy("p").agg(
        F.max(F.when(F.col("own"), F.col("c"))).alias("c"), F.max(F.when(F.col("own"), F.col("n"))).alias("n"),
        F.max(F.when(F.col("own"), F.try_divide("s", F.col("n") - 1))).alias("a"), F.min(F.when(~F.col("own"), F.col("s") / F.col("n"))).alias("b"))
    s = F.when(F.col("b").isNull(), F.lit(None)).when(F.col("n") <= 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return each.select("c", "a", "b", s.alias("s"))


def silhouette(frame: DataFrame, features: list[str] | str, cluster: str, block: int | None = None) -> DataFrame:
    """Mean Euclidean silhouette (one row)."""
    return point_silhouettes(frame, features, cluster, block).agg(F.avg("s").alias("silhouette"))
