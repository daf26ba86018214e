"""Clustering on Spark ML plus cluster-quality measures written as aggregates.

* Standardisation uses population moments (ddof=0; Spark ML's StandardScaler uses ddof=1).
* K-means: all seeds and all k are fitted together, one pass per step (``kmeans``); the best of the
  seeds by cost is kept.
* Quality measures take any label column, so they also work for non-fitted partitions:
  inertia, Calinski–Harabasz and Davies–Bouldin from per-cluster aggregates. The number
  of clusters is chosen by the Euclidean silhouette (``silhouette``, exact, quadratic in the
  clusters' sizes); the one with squared distances decomposes into per-cluster sums
  (the same definition as Spark's ``ClusteringEvaluator``) and stays linear.
* Stability compares with Ward's linkage (``ward``).
* Per-cluster tables have k rows; they are packed into one array (bounded by k) and
  evaluated with higher-order functions instead of joining points to every cluster.
  Points are arrays, so the plan does not grow with the number of features.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import PCA
from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators import kmeans as KM
from kestrel.operators.joins import join_small
from kestrel.operators.model import adjusted_rand
from kestrel.operators.silhouette import silhouette
from kestrel.operators.ward import ward_clusters
from kestrel.session import cut_lineage

SEEDS = tuple(42 + 1000 * i for i in range(10))


MAX_CLUSTERS = 10_000  # labels beyond that raise: quality measures compare every point with every cluster


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("__one", F.lit(1))


def standardize(frame: DataFrame, features: list[str], prefix: str = "") -> DataFrame:
    """z = (x - mean) / std_pop; a zero-variance feature keeps scale 1 (so z = 0)."""
    stats = frame.agg(*[x for f in features for x in (F.avg(f).alias(f"__mu_{f}"), F.stddev_pop(f).alias(f"__sd_{f}"))])
    j = join_small(_one(frame), _one(stats), "__one", "inner", bound=1)
    cols = {}
    for f in features:
        sd = F.col(f"__sd_{f}")
        cols[f"{prefix}{f}"] = (F.col(f) - F.col(f"__mu_{f}")) / F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
    out = j.withColumns(cols)
    return out.drop("__one", *[c for c in out.columns if c.startswith("__mu_") or c.startswith("__sd_")])


def assemble(frame: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return frame.withColumn(out, array_to_vector(F.array(*[F.col(f).cast("double") for f in features])))


def kmeans_best(vectors: DataFrame, k: int, seeds=SEEDS, features: str = "features", max_iter: int = 300):
    """(model, cost) of the seed with the lowest cost (inertia)."""
    model = KM.best_of(KM.fit_many(vectors, [k], list(seeds), features, max_iter), k)
    return model, model.cost


# ------------------------------------------------------------------ quality measures
# Points are handled as one array<double> column and every per-point formula is a
# higher-order function over it, so plan size (and driver work) does not grow with the
# number of features. Per-cluster means come from Spark ML's vector Summarizer.

def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, b: a + b)


def _sqdist(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)))


def _dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda p, q: p * q))


def _points(frame: DataFrame, features: list[str] | str, cluster: str) -> DataFrame:
    """(cluster, __v): the feature columns as one array, or the array column of that name."""
    if isinstance(features, str):
        return frame.select(F.col(cluster), F.col(features).cast("array<double>").alias("__v"))
    return frame.select(F.col(cluster), F.array(*[F.col(f).cast("double") for f in features]).alias("__v"))


def _mean_vector(col: str = "__v") -> Column:
    return vector_to_array(Summarizer.mean(array_to_vector(F.col(col))))


def centroids(points: DataFrame, cluster: str) -> DataFrame:
    """Per cluster: size, mean vector, mean squared norm."""
    return points.groupBy(cluster).agg(F.count(F.lit(1)).alias("__n"), _mean_vector().alias("__c"),
                                       F.avg(_dot(F.col("__v"), F.col("__v"))).alias("__m2"))


def _with_centroid(points: DataFrame, c: DataFrame, cluster: str) -> DataFrame:
    return points.join(c, cluster)  # broadcast by its size at run time


def inertia(frame: DataFrame, features: list[str], cluster: str) -> DataFrame:
    pts = _points(frame, features, cluster)
    j = _with_centroid(pts, centroids(pts, cluster), cluster)
    return j.agg(F.sum(_sqdist(F.col("__v"), F.col("__c"))).alias("inertia"))


def calinski_harabasz(frame: DataFrame, features: list[str], cluster: str) -> DataFrame:
    pts = _points(frame, features, cluster)
    c = centroids(pts, cluster)
    ssw = _with_centroid(pts, c, cluster).agg(F.sum(_sqdist(F.col("__v"), F.col("__c"))).alias("ssw"),
                                              F.count(F.lit(1)).alias("n"))
    grand = pts.agg(_mean_vector().alias("__g"))
    cg = join_small(_one(c), _one(grand), "__one", "inner", bound=1)
    ssb = cg.agg(F.sum(F.col("__n") * _sqdist(F.col("__c"), F.col("__g"))).alias("ssb"), F.count(F.lit(1)).alias("k"))
    both = join_small(_one(ssw), _one(ssb), "__one", "inner", bound=1)
    ch = F.when(F.col("ssw") == 0, F.lit(1.0)).otherwise(
        F.try_divide(F.col("ssb") * (F.col("n") - F.col("k")), F.col("ssw") * (F.col("k") - 1)))  # one cluster: null
    return both.select(ch.alias("calinski_harabasz"))


def _packed(c: DataFrame, cluster: str, extra: list[str]) -> DataFrame:
    item = F.struct(F.col(cluster).alias("id"), F.col("__c").alias("c"), *[F.col(x).alias(x) for x in extra])
    packed = c.agg(F.collect_list(item).alias("__all"), F.count(F.lit(1)).alias("__k"))
    # every point is compared with every cluster: k is a model's, never a data column's cardinality
    return packed.select(F.when(F.col("__k") <= MAX_CLUSTERS, F.col("__all")).otherwise(
        F.raise_error(F.lit(f"more than {MAX_CLUSTERS} clusters: the labels are no clustering"))).alias("__all"))


def davies_bouldin(frame: DataFrame, features: list[str], cluster: str) -> DataFrame:
    pts = _points(frame, features, cluster)
    c = centroids(pts, cluster)
    spread = _with_centroid(pts, c, cluster).groupBy(cluster).agg(
        F.avg(F.sqrt(_sqdist(F.col("__v"), F.col("__c")))).alias("__s"))
    cs = c.join(spread, cluster)
    rows = join_small(_one(cs), _one(_packed(cs, cluster, ["__s"])), "__one", "inner", bound=1)

    def ratio(o):
        d = F.sqrt(_sqdist(o["c"], F.col("__c")))
        return F.when((o["id"] == F.col(cluster)) | (d == 0), F.lit(0.0)).otherwise((o["__s"] + F.col("__s")) / d)

    return rows.agg(F.avg(F.array_max(F.transform(F.col("__all"), ratio))).alias("davies_bouldin"))


def silhouette_sq(frame: DataFrame, features: list[str], cluster: str) -> DataFrame:
    """Mean silhouette with squared Euclidean distance (singleton clusters score 0)."""
    pts = _points(frame, features, cluster)
    packed = _packed(centroids(pts, cluster), cluster, ["__n", "__m2"])
    j = join_small(_one(pts), _one(packed), "__one", "inner", bound=1)
    x = F.col("__v")
    xx = _dot(x, x)

    def mean_d2(o):  # mean squared distance from x to the members of cluster o
        return xx - 2 * _dot(o["c"], x) + o["__m2"]

    own = F.filter(F.col("__all"), lambda o: o["id"] == F.col(cluster))[0]
    others = F.filter(F.col("__all"), lambda o: o["id"] != F.col(cluster))
    a = mean_d2(own) * own["__n"] / (own["__n"] - 1)
    b = F.array_min(F.transform(others, mean_d2))
    s = F.when(own["__n"] <= 1, F.lit(0.0)).otherwise(F.try_divide(b - a, F.greatest(a, b)))
    return j.agg(F.avg(F.coalesce(s, F.lit(0.0))).alias("silhouette_sq_euclidean"))


def quality_row(frame: DataFrame, features: list[str], cluster: str) -> DataFrame:
    parts = [silhouette_sq(frame, features, cluster), calinski_harabasz(frame, features, cluster),
             davies_bouldin(frame, features, cluster), inertia(frame, features, cluster)]
    return reduce(lambda a, b: join_small(_one(a), _one(b), "__one", "inner", bound=1).drop("__one"), parts)


# ------------------------------------------------------------------ model selection
def prepare(frame: DataFrame, features: list[str]) -> DataFrame:
    """Standardised feature columns + vector, written once: it is reused by every fit."""
    z = standardize(frame, features)
    return cut_lineage(assemble(z, features))


def select_k(vectors: DataFrame, features: list[str], k_max: int = 6, n_rows: int | None = None,
             seeds=SEEDS) -> DataFrame:
    """k = 2..min(k_max, n-1): silhouettes (Euclidean and squared), CH, DB, inertia of the best-of-seeds k-means."""
    n = n_rows if n_rows is not None else vectors.count()
    ks = list(range(2, min(k_max, n - 1) + 1))
    if not ks:
        raise ValueError(f"{n} rows leave no number of clusters to choose")
    fits = KM.fit_many(vectors, ks, list(seeds))
    out = None
    for k in ks:
        labelled = KM.best_of(fits, k).transform(vectors)
        # the labels are written once; the four measures read them
        labelled = cut_lineage(labelled.select(*features, "raw_cluster"))
        both = join_small(_one(silhouette(labelled, features, "raw_cluster")), _one(quality_row(labelled, features, "raw_cluster")), "__one", "inner", bound=1)
        row = both.drop("__one").select(F.lit(k).alias("k"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def best_k(selection: DataFrame) -> int:
    """The k of the largest silhouette (the Euclidean one where the table has it), the smallest such k on a tie (one row per k)."""
    column = "silhouette" if "silhouette" in selection.columns else "silhouette_sq_euclidean"
    return selection.orderBy(F.col(column).desc_nulls_last(), "k").first()["k"]


def kmeans_auto(vectors: DataFrame, features: list[str], k: int | None = None, k_max: int = 6, seeds=SEEDS):
    """(model, cost, k): the given k, or without one the best of :func:`select_k`."""
    chosen = k if k is not None else best_k(select_k(vectors, features, k_max, seeds=seeds))
    return (*kmeans_best(vectors, chosen, seeds), chosen)


def pca_scores(vectors: DataFrame, n_components: int = 2, features: str = "features") -> DataFrame:
    """Principal-component scores; each component's sign makes its largest loading positive."""
    model = PCA(k=n_components, inputCol=features, outputCol="__pcs").fit(vectors)
    loadings = model.pc.toArray()  # d x n_components model parameters, not data
    signs = []
    for j in range(n_components):
        col = loadings[:, j]
        signs.append(1.0 if col[abs(col).argmax()] >= 0 else -1.0)
    arr = F.col("__pcs_arr")
    out = model.transform(vectors).withColumn("__pcs_arr", vector_to_array(F.col("__pcs")))
    return out.withColumns({f"pc{j + 1}": arr[j] * F.lit(signs[j]) for j in range(n_components)}).drop("__pcs", "__pcs_arr")


def stability(vectors: DataFrame, k: int, labels: str = "raw_cluster", features: list[str] | str = "features") -> DataFrame:
    """Agreement (adjusted Rand) between given labels, as of a k-means, and Ward's clusters at the same k."""
    return adjusted_rand(ward_clusters(vectors, features, k, "__ward"), labels, "__ward")
