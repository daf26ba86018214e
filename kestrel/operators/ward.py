"""Ward's agglomerative clustering of any number of points.

1. *Cluster features.* A cluster feature holds the number of its points, their mean and their sum of
   squared deviations; two of them merge exactly. Every task inserts its points into a CF-tree
   of its own, which holds at most ``max_features`` leaf features: a point is absorbed by the
   feature it costs least variance to join, if the joint variance stays within the tree's
   threshold, else it starts a new one; a tree that is full grows its threshold and is rebuilt from its
   own features. Trees of several tasks are merged in rounds, MERGE_FAN into one, by inserting their
   features, so no task and no message ever holds more than ``MERGE_FAN * max_features`` of them.
2. *Linkage.* The features that are left (their number is bounded by the parameter, not by the data) are
   linked by the nearest-neighbour chain: Ward's cost of a merge follows from sizes and means alone, so memory is
   linear in the features. The merges, sorted by cost, are cut at k clusters.
3. *Labels.* Every point gets the label of its nearest feature.

The threshold starts at 0, where only equal points share a feature: up to ``max_features`` distinct
points the result is Ward's clustering of the points themselves. Beyond, it is Ward's clustering of
features that summarise all points.

Defined results: points with a null or non-finite component get no label; fewer distinct points
than k give as many clusters; labels number clusters by their smallest member in the order of the
points' components, so they don't depend on the partitioning; an empty frame stays empty.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import cut_lineage

# the functions below travel to the executors by value: they need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_FEATURES = 2000
BRANCHING = 32
MERGE_FAN = 16
FEATURE = "part int, n double, mean array<double>, dev double, threshold double"


class _Node:
    """A node of the tree: entries (n, mean, dev) and, above the leaves, the child of each."""

    __slots__ = ("n", "mean", "dev", "size", "children")

    def __init__(self, dims: int, leaf: bool):
        self.n = np.zeros(BRANCHING + 1)
        self.mean = np.zeros((BRANCHING + 1, dims))
        self.dev = np.zeros(BRANCHING + 1)
        self.size = 0
        self.children: list[_Node] | None = None if leaf else []

    def put(self, i: int, n: float, mean: np.ndarray, dev: float) -> None:
        self.n[i], self.mean[i], self.dev[i] = n, mean, dev

    def absorb(self, i: int, n: float, mean: np.ndarray, dev: float) -> None:
        self.put(i, *merged(self.n[i], self.mean[i], self.dev[i], n, mean, dev))

    def total(self) -> tuple[float, np.ndarray, float]:
        n = self.n[:self.size].sum()
        mean = (self.n[:self.size, None] * self.mean[:self.size]).sum(axis=0) / n
        gap = self.mean[:self.size] - mean
        return n, mean, self.dev[:self.size].sum() + (self.n[:self.size] * (gap * gap).sum(axis=1)).sum()

    def costs(self, n: float, mean: np.ndarray) -> np.ndarray:
        """What joining each entry would add to its squared deviations (Ward's cost)."""
        gap = self.mean[:self.size] - mean
        return self.n[:self.size] * n / (self.n[:self.size] + n) * (gap * gap).sum(axis=1)


def merged(n1, mean1, dev1, n2, mean2, dev2):
    n = n1 + n2
    gap = mean2 - mean1
    return n, mean1 + gap * (n2 / n), dev1 + dev2 + (gap * gap).sum() * (n1 * n2 / n)


class CFTree:
    def __init__(self, dims: int, max_features: int, threshold: float = 0.0):
        self.dims, self.max_features, self.threshold = dims, max_features, threshold
        self.root, self.features = _Node(dims, leaf=True), 0

    def insert(self, n: float, mean: np.ndarray, dev: float) -> None:
        split = self._insert(self.root, n, mean, dev)
        if split is not None:
            above = _Node(self.dims, leaf=False)
            for i, child in enumerate((self.root, split)):
                above.put(i, *child.total())
                above.children.append(child)
            above.size = 2
            self.root = above
        if self.features > self.max_features:
            self._rebuild()

    def _insert(self, node: _Node, n: float, mean: np.ndarray, dev: float) -> _Node | None:
        costs = node.costs(n, mean) if node.size else np.empty(0)
        i = int(costs.argmin()) if len(costs) else -1
        if node.children is None:
            # variance of the joint feature per point
            if i >= 0 and (costs[i] + node.dev[i] + dev) <= self.threshold * (node.n[i] + n):
                node.absorb(i, n, mean, dev)
                return None
            node.put(node.size, n, mean, dev)
            node.size += 1
            self.features += 1
        else:
            split = self._insert(node.children[i], n, mean, dev)
            if split is None:
                node.absorb(i, n, mean, dev)
                return None
            node.put(i, *node.children[i].total())
            node.put(node.size, *split.total())
            node.children.append(split)
            node.size += 1
        return self._split(node) if node.size > BRANCHING else None

    def _split(self, node: _Node) -> _Node:
        """Deal the entries to the two that are farthest apart; the second part is returned."""
        mean = node.mean[:node.size]
        gaps = ((mean[:, None, :] - mean[None]) ** 2).sum(axis=2)
        a, b = divmod(int(gaps.argmax()), node.size)
        second = gaps[b] < gaps[a]
        second[b], second[a] = True, False
        if gaps[a, b] == 0:  # equal means: any half
            second = np.arange(node.size) >= node.size // 2
        out = _Node(self.dims, leaf=node.children is None)
        entries = [(node.n[i], node.mean[i].copy(), node.dev[i]) for i in range(node.size)]
        children = node.children
        for part, which in ((out, np.flatnonzero(second)), (node, np.flatnonzero(~second))):
            for at, i in enumerate(which):
                part.put(at, *entries[i])
            part.size = len(which)
            if children is not None:
                part.children = [children[i] for i in which]
        return out

    def leaves(self) -> Iterator[_Node]:
        held = [self.root]
        while held:
            node = held.pop()
            if node.children is None:
                yield node
            else:
                held += node.children

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        leaves = list(self.leaves())
        return (np.concatenate([x.n[:x.size] for x in leaves]), np.concatenate([x.mean[:x.size] for x in leaves]),
                np.concatenate([x.dev[:x.size] for x in leaves]))

    def _rebuild(self) -> None:
        """Raise the threshold to the middle of what neighbours in the leaves would need, twice the old one at least."""
        needed = []
        for leaf in self.leaves():
            if leaf.size > 1:
                for i in range(leaf.size):
                    costs = leaf.costs(leaf.n[i], leaf.mean[i])
                    costs = (costs + leaf.dev[:leaf.size] + leaf.dev[i]) / (leaf.n[:leaf.size] + leaf.n[i])
                    costs[i] = np.inf
                    needed.append(costs.min())
        n, mean, dev = self.rows()
        self.threshold = max(2 * self.threshold, float(np.median(needed)) if needed else 0.0, np.finfo(float).tiny)
        self.root, self.features = _Node(self.dims, leaf=True), 0
        for i in range(len(n)):
            self.insert(n[i], mean[i], dev[i])


def _point_trees(max_features: int):
    """mapInPandas body over points (__v): FEATURE rows of a task's tree."""
    def run(batches):
        tree = None
        for batch in batches:
            if not len(batch):
                continue
            points, counts = np.unique(np.stack(batch["__v"].to_numpy()), axis=0, return_counts=True)
            tree = tree or CFTree(points.shape[1], max_features)
            for point, n in zip(points, counts):
                tree.insert(float(n), point, 0.0)
        if tree is not None:
            yield _feature_rows(tree)
    return run


def _merged_trees(max_features: int):
    """mapInPandas body over FEATURE rows: those of one tree of all of a task's features."""
    def run(batches):
        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pd.concat(held)
        mean = np.stack(rows["mean"].to_numpy())
        order = np.lexsort(mean.T[::-1])  # whichever task sent first
        tree = CFTree(mean.shape[1], max_features, float(rows["threshold"].max()))
        n, dev = rows["n"].to_numpy(), rows["dev"].to_numpy()
        for i in order:
            tree.insert(n[i], mean[i], dev[i])
        yield _feature_rows(tree)
    return run


def _feature_rows(tree: CFTree) -> pd.DataFrame:
    n, mean, dev = tree.rows()
    # a feature's part decides which others it meets next; a task's features stay together
    part = zlib.crc32(mean.tobytes()) >> 1
    return pd.DataFrame({"part": np.full(len(n), part, np.int32), "n": n, "mean": list(mean), "dev": dev, "threshold": tree.threshold})


def cluster_features(points: DataFrame, max_features: int = MAX_FEATURES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, means, dev) of at most ``max_features`` features of all points (column __v)."""
    trees = points.mapInPandas(_point_trees(max_features), FEATURE)
    trees = cut_lineage(trees)
    parts = trees.select("part").distinct().count()
    while parts > 1:
        parts = -(-parts // MERGE_FAN)
        trees = cut_lineage(trees.repartition(parts, F.pmod("part", F.lit(parts))).mapInPandas(_merged_trees(max_features), FEATURE))
    rows = trees.select("n", "mean", "dev").toPandas()  # max_features rows at most
    if not len(rows):
        return np.empty(0), np.empty((0, 0)), np.empty(0)
    mean = np.stack(rows["mean"].to_numpy())
    order = np.lexsort(mean.T[::-1])
    return rows["n"].to_numpy()[order], mean[order], rows["dev"].to_numpy()[order]


def linkage(n: np.ndarray, mean: np.ndarray) -> list[tuple[int, int, float]]:
    """Ward's merges (a, b, cost) of features, cheapest first; a and b are features standing for the
    clusters they belong to. A chain of nearest neighbours grows until two are each other's nearest;
    merging them spoils nothing before them, because Ward's costs are reducible."""
    n, mean = n.astype(float).copy(), mean.astype(float).copy()
    alive = np.ones(len(n), dtype=bool)
    merges, chain = [], []

    def costs(i: int) -> np.ndarray:
        gap = mean - mean[i]
        out = n * n[i] / (n + n[i]) * (gap * gap).sum(axis=1)
        out[~alive] = np.inf
        out[i] = np.inf
        return out

    while alive.sum() > 1:
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        near = costs(chain[-1])
        best = int(near.argmin())
        if len(chain) > 1 and near[chain[-2]] <= near[best]:  # the one before, if as near
            a, b = sorted((chain.pop(), chain.pop()))
            merges.append((a, b, float(near.min())))
            total = n[a] + n[b]
            mean[a] += (mean[b] - mean[a]) * (n[b] / total)
            n[a], alive[b] = total, False
        else:
            chain.append(best)
    return sorted(merges, key=lambda m: m[2])  # stable: of equal costs those found first


def cut(size: int, merges: list[tuple[int, int, float]], k: int) -> np.ndarray:
    """Label of every feature after all but the k - 1 dearest merges, numbered by first feature."""
    parent = list(range(size))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b, _ in merges[:max(size - k, 0)]:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    tops = np.array([top(i) for i in range(size)], dtype=np.int64)
    return np.unique(tops, return_inverse=True)[1]


def _labeller(mean: np.ndarray, labels: np.ndarray):
    def label(points: pd.Series) -> pd.Series:
        out = np.full(len(points), -1)
        ok = np.flatnonzero(points.notna().to_numpy())
        for rows in np.array_split(ok, max(1, -(-len(ok) // 256))):
            if len(rows):
                x = np.stack(points.iloc[rows].to_numpy())
                out[rows] = labels[((x[:, None, :] - mean[None]) ** 2).sum(axis=2).argmin(axis=1)]
        return pd.Series(pd.array(np.where(out < 0, None, out), dtype="Int32"))
    return F.pandas_udf(label, "int")


def ward_clusters(frame: DataFrame, features: list[str] | str, k: int, out: str = "ward_cluster", max_features: int = MAX_FEATURES) -> DataFrame:
    """``frame`` with Ward's cluster of each row at k clusters, over the feature columns (or one array column)."""
    arr = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(*[F.col(f).cast("double") for f in features])
    finite = F.forall(arr, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    tagged = frame.withColumn("__v", F.when(finite, arr))
    points = cut_lineage(tagged.where(F.col("__v").isNotNull()).select("__v"))
    n, mean, _ = cluster_features(points, max_features)
    if not len(n):
        return frame.withColumn(out, F.lit(None).cast("int"))
    labels = cut(len(n), linkage(n, mean), k)
    return tagged.withColumn(out, _labeller(mean, labels)("__v")).drop("__v")
