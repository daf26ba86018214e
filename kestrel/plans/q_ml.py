"""Clustering queries: standardisation, quality measures on a fixed partition (SQL-checked)
and fitted k-means / model selection / PCA / stability / region table (row-count checked)."""

from __future__ import annotations



from pyspark.ml.feature import StandardScaler
from pyspark.sql import functions as F

from kestrel.functions.labels import tier_name
from kestrel.operators import ml as ML
from kestrel.operators import model as M
from kestrel.operators.silhouette import silhouette as euclidean_silhouette
from kestrel.operators.ward import ward_clusters as ward
from kestrel.plans.catalog import query
from kestrel.plans.output import canonical, r
from kestrel.session import cut_lineage
from kestrel.plans.q_model import (CONTEXT_METRIC, DEV_METRIC, FEATURES, K, MF_SQL, PROFILE_COLS, SPEC,
                                   model_frame)

_X = FEATURES
Z_SQL = f"""{MF_SQL},
z AS (SELECT entity, cluster_id, {', '.join(f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0e0 ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS {c}" for c in _X)} FROM cl),
c AS (SELECT cluster_id, count(*) AS n, {', '.join(f'avg({c}) AS c_{c}' for c in _X)},
             avg({' + '.join(f'{c} * {c}' for c in _X)}) AS m2 FROM z GROUP BY cluster_id),
zc AS (SELECT z.*, c.n, {', '.join(f'c.c_{c}' for c in _X)}, {' + '.join(f'(z.{c} - c.c_{c}) * (z.{c} - c.c_{c})' for c in _X)} AS d2
       FROM z JOIN c USING (cluster_id))"""


def scaled_frame(spark, sf_dir):
    return ML.standardize(model_frame(spark, sf_dir), FEATURES)


@query("standardize", f"{Z_SQL}\nSELECT entity, {', '.join(f'{r(c)} AS {c}' for c in _X)} FROM z")
def standardize(spark, sf_dir):
    """Population z-scores of the clustering features over the snapshot."""
    return canonical(scaled_frame(spark, sf_dir).select("entity", *FEATURES))


@query("cluster_inertia", f"{Z_SQL}\nSELECT {r('sum(d2)')} AS inertia FROM zc")
def cluster_inertia(spark, sf_dir):
    return canonical(ML.inertia(scaled_frame(spark, sf_dir), FEATURES, "cluster_id"))


@query("calinski_harabasz", f"""{Z_SQL},
g AS (SELECT {', '.join(f'avg({c}) AS g_{c}' for c in _X)} FROM z),
b AS (SELECT sum(n * ({' + '.join(f'(c_{c} - g_{c}) * (c_{c} - g_{c})' for c in _X)})) AS ssb, count(*) AS k FROM c JOIN g ON TRUE),
w AS (SELECT sum(d2) AS ssw, count(*) AS n FROM zc)
SELECT {r('CASE WHEN ssw = 0 THEN 1.0e0 ELSE ssb * (n - k) / (ssw * (k - 1)) END')} AS calinski_harabasz FROM b JOIN w ON TRUE""")
def calinski_harabasz(spark, sf_dir):
    return canonical(ML.calinski_harabasz(scaled_frame(spark, sf_dir), FEATURES, "cluster_id"))


@query("davies_bouldin", f"""{Z_SQL},
s AS (SELECT cluster_id, avg(sqrt(d2)) AS sp FROM zc GROUP BY cluster_id),
cs AS (SELECT * FROM c JOIN s USING (cluster_id)),
pr AS (SELECT i.cluster_id, max(CASE WHEN i.cluster_id = j.cluster_id THEN 0.0e0
         WHEN sqrt({' + '.join(f'(i.c_{c} - j.c_{c}) * (i.c_{c} - j.c_{c})' for c in _X)}) = 0 THEN 0.0e0
         ELSE (i.sp + j.sp) / sqrt({' + '.join(f'(i.c_{c} - j.c_{c}) * (i.c_{c} - j.c_{c})' for c in _X)}) END) AS worst
       FROM cs i JOIN cs j ON TRUE GROUP BY i.cluster_id)
SELECT {r('avg(worst)')} AS davies_bouldin FROM pr""")
def davies_bouldin(spark, sf_dir):
    return canonical(ML.davies_bouldin(scaled_frame(spark, sf_dir), FEATURES, "cluster_id"))


@query("silhouette", f"""{Z_SQL},
pd AS (SELECT z.entity, z.cluster_id AS own, c.cluster_id AS other, c.n,
              ({' + '.join(f'z.{x} * z.{x}' for x in _X)}) - 2 * ({' + '.join(f'z.{x} * c.c_{x}' for x in _X)}) + c.m2 AS d
       FROM z JOIN c ON TRUE),
ab AS (SELECT entity, max(CASE WHEN own = other THEN d * n / (n - 1) END) AS a, min(CASE WHEN own <> other THEN d END) AS b,
              max(CASE WHEN own = other THEN n END) AS nown FROM pd GROUP BY entity)
SELECT {r('avg(CASE WHEN nown <= 1 THEN 0.0e0 ELSE coalesce((b - a) / NULLIF(greatest(a, b), 0), 0.0e0) END)')} AS silhouette_sq_euclidean FROM ab""")
def silhouette(spark, sf_dir):
    """Silhouette (squared Euclidean) of the tertile partition on standardised features."""
    return canonical(ML.silhouette_sq(scaled_frame(spark, sf_dir), FEATURES, "cluster_id"))


@query("silhouette_euclidean", f"""{Z_SQL},
pd AS (SELECT x.entity, x.cluster_id AS own, y.cluster_id AS other, sum(sqrt({' + '.join(f'(x.{c} - y.{c}) * (x.{c} - y.{c})' for c in _X)})) AS s, count(*) AS n
       FROM z x JOIN z y ON x.entity <> y.entity GROUP BY 1, 2, 3),
ab AS (SELECT entity, max(CASE WHEN own = other THEN s / n END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b FROM pd GROUP BY entity)
SELECT {r('avg(CASE WHEN a IS NULL THEN 0.0e0 ELSE coalesce((b - a) / NULLIF(greatest(a, b), 0), 0.0e0) END)')} AS silhouette FROM ab""")
def silhouette_euclidean(spark, sf_dir):
    """Silhouette (Euclidean) of the tertile partition on standardised features."""
    return canonical(euclidean_silhouette(scaled_frame(spark, sf_dir), FEATURES, "cluster_id"))


@query("embedding_silhouette", f"""
WITH e AS (SELECT row_number() OVER () AS p, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT x.p, x.label AS own, y.label AS other, sum(list_distance(x.v, y.v)) AS s, count(*) AS n FROM e x JOIN e y ON x.p <> y.p GROUP BY 1, 2, 3),
ab AS (SELECT p, max(CASE WHEN own = other THEN s / n END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b FROM d GROUP BY p)
SELECT {r('avg(CASE WHEN a IS NULL THEN 0.0e0 ELSE coalesce((b - a) / NULLIF(greatest(a, b), 0), 0.0e0) END)')} AS silhouette FROM ab""")
def embedding_silhouette(spark, sf_dir):
    """Silhouette (Euclidean) of the stored labels as a partition of the embedding space."""
    from kestrel.plans.testdata import table
    return canonical(euclidean_silhouette(table(spark, sf_dir, "embeddings"), "embedding", "label"))


#: Ward's linkage step by step: a list of clusters loses the two that cost least to join and gains their union.
WARD_SQL = f"""{Z_SQL.replace('WITH ', 'WITH RECURSIVE ', 1)},
steps AS (
  SELECT list({{'m': [entity], 'n': 1.0e0, 'c': [{', '.join(_X)}]}} ORDER BY entity) AS cl FROM z
  UNION ALL
  SELECT list_concat(list_filter(cl, lambda x, pos: pos <> best.i AND pos <> best.j),
           [{{'m': list_concat(cl[best.i].m, cl[best.j].m), 'n': cl[best.i].n + cl[best.j].n,
             'c': list_transform(range(1, {len(_X) + 1}), lambda t: (cl[best.i].n * cl[best.i].c[t] + cl[best.j].n * cl[best.j].c[t]) / (cl[best.i].n + cl[best.j].n))}}])
  FROM (SELECT cl, list_min(flatten(list_transform(range(1, len(cl) + 1), lambda i: list_transform(range(i + 1, len(cl) + 1),
          lambda j: {{'d': cl[i].n * cl[j].n / (cl[i].n + cl[j].n) * ({' + '.join(f'(cl[i].c[{t + 1}] - cl[j].c[{t + 1}]) * (cl[i].c[{t + 1}] - cl[j].c[{t + 1}])' for t in range(len(_X)))}), 'i': i, 'j': j}})))) AS best
        FROM steps WHERE len(cl) > {K}) b),
ward AS (SELECT unnest(c.m) AS entity, list_min(c.m) AS ward_cluster FROM (SELECT unnest(cl) AS c FROM steps WHERE len(cl) <= {K}) u)"""


@query("ward_clusters", f"{WARD_SQL}\nSELECT entity, ward_cluster FROM ward")
def ward_clusters(spark, sf_dir):
    """Ward's clusters of the standardised features, each named by its smallest entity."""
    out = cut_lineage(ward(scaled_frame(spark, sf_dir), FEATURES, K).select("entity", "ward_cluster"))
    names = out.groupBy("ward_cluster").agg(F.min("entity").alias("name"))
    return out.join(names, "ward_cluster").select("entity", F.col("name").alias("ward_cluster"))


@query("ward_agreement", f"""{WARD_SQL},
t AS (SELECT cluster_id, ward_cluster, count(*) AS n FROM z JOIN ward USING (entity) GROUP BY ALL),
s AS (SELECT sum(n * (n - 1) / 2) AS sij, sum(n) AS total FROM t),
a AS (SELECT sum(n * (n - 1) / 2) AS sa FROM (SELECT sum(n) AS n FROM t GROUP BY cluster_id) x),
b AS (SELECT sum(n * (n - 1) / 2) AS sb FROM (SELECT sum(n) AS n FROM t GROUP BY ward_cluster) y)
SELECT {r('CASE WHEN (sa + sb) / 2 = sa * sb / (total * (total - 1) / 2) THEN 1.0e0 ELSE (sij - sa * sb / (total * (total - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (total * (total - 1) / 2)) END')} AS adjusted_rand,
       CAST(total AS BIGINT) AS n FROM s, a, b""")
def ward_agreement(spark, sf_dir):
    """Adjusted Rand agreement of the tertile partition with Ward's linkage."""
    return canonical(ML.stability(scaled_frame(spark, sf_dir), K, "cluster_id", FEATURES))


def _vectors(spark, sf_dir):
    # the SQL-checked queries carry a tertile partition as cluster_id; fitted labels replace it
    return ML.prepare(model_frame(spark, sf_dir).drop("cluster_id"), FEATURES)


@query("kmeans_clusters", None)
def kmeans_clusters(spark, sf_dir):
    """k-means (best of 10 seeds), clusters renamed so 0 has the highest mean score."""
    vec = _vectors(spark, sf_dir)
    model, _ = ML.kmeans_best(vec, K)
    labelled = M.relabel_by_score(model.transform(vec), "raw_cluster", SPEC.score_col, "kmeans_cluster")
    return labelled.select("entity", "entity_name", "raw_cluster", "kmeans_cluster")


@query("select_k", None)
def select_k(spark, sf_dir):
    """Silhouette / CH / DB / inertia for k = 2..6 (best-of-seeds k-means each)."""
    return canonical(ML.select_k(_vectors(spark, sf_dir), FEATURES, 6))


@query("pca_scores", None)
def pca_scores(spark, sf_dir):
    """Two principal-component scores per entity (sign: largest loading positive)."""
    return canonical(ML.pca_scores(_vectors(spark, sf_dir), 2).select("entity", "pc1", "pc2"))


@query("cluster_stability", None)
def cluster_stability(spark, sf_dir):
    """Adjusted Rand agreement of k-means with Ward's linkage on the same vectors."""
    vec = _vectors(spark, sf_dir)
    model, _ = ML.kmeans_best(vec, K)
    return canonical(ML.stability(model.transform(vec), K, "raw_cluster", features=FEATURES))


@query("region_table", None)
def region_table(spark, sf_dir):
    """Full modelling output per entity: cluster, tier, archetype, PCs, level, action."""
    vec = _vectors(spark, sf_dir)
    model, _ = ML.kmeans_best(vec, K)
    labelled = M.relabel_by_score(model.transform(vec), "raw_cluster", SPEC.score_col, "cluster_id")
    raw = labelled
    prof = M.cluster_profiles(raw, K, PROFILE_COLS, DEV_METRIC, "m_ret")
    out = M.attach_cluster_labels(raw, prof)
    pcs = ML.pca_scores(vec, 2).select("entity", "pc1", "pc2")
    out = out.join(pcs, "entity", "left").withColumn("tier", tier_name("cluster_id", K))
    cols = ["entity", "entity_name", "period", *FEATURES, CONTEXT_METRIC, SPEC.score_col, "cluster_id", "tier",
            "archetype", "entity_type", "pc1", "pc2", "trend_slope", "trend_label", "vulnerability_level",
            "priority_action"]
    # output order of the table: cluster, then score (highest first)
    return canonical(out.select(*cols)).orderBy("cluster_id", F.col(SPEC.score_col).desc_nulls_last(), "entity")




@query("embedding_kmeans", None)
def embedding_kmeans(spark, sf_dir):
    """k-means on the stored embedding vectors (k = 10, best of 10 seeds) and its agreement
    (adjusted Rand) with the stored labels."""
    from pyspark.ml.functions import array_to_vector

    from kestrel.operators.model import adjusted_rand
    from kestrel.plans.testdata import table
    emb = table(spark, sf_dir, "embeddings").select("label", array_to_vector(F.col("embedding").cast("array<double>")).alias("raw"))
    scaled = StandardScaler(withMean=True, withStd=True, inputCol="raw", outputCol="features").fit(emb).transform(emb)
    vec = cut_lineage(scaled.select("label", "features"))
    model, _ = ML.kmeans_best(vec, 10)
    return canonical(adjusted_rand(model.transform(vec), "label", "raw_cluster"))


@query("embedding_label_quality", f"""
WITH e AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
g AS (SELECT label, i, avg(x) AS c FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e) t GROUP BY 1, 2),
c AS (SELECT a.label, a.n, a.m2, b.c FROM (SELECT label, count(*) AS n, avg(list_inner_product(v, v)) AS m2 FROM e GROUP BY label) a
      JOIN (SELECT label, list(c ORDER BY i) AS c FROM g GROUP BY label) b USING (label)),
grand AS (SELECT list(m ORDER BY i) AS gm FROM (SELECT i, avg(x) AS m FROM (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e) t GROUP BY i) u),
p AS (SELECT row_number() OVER () AS id, e.label, e.v, list_inner_product(e.v, e.v) AS xx FROM e),
d AS (SELECT p.id, p.label, c.label AS o, c.n, p.xx - 2 * list_inner_product(c.c, p.v) + c.m2 AS md,
             p.xx - 2 * list_inner_product(c.c, p.v) + list_inner_product(c.c, c.c) AS sq FROM p, c),
s AS (SELECT id, max(CASE WHEN label = o THEN md * n / (n - 1) END) AS a, min(CASE WHEN label <> o THEN md END) AS b, max(CASE WHEN label = o THEN sq END) AS own,
             any_value(label) AS label FROM d GROUP BY id),
w AS (SELECT label, avg(sqrt(own)) AS spread FROM s GROUP BY label),
db AS (SELECT x.label, max((wx.spread + wy.spread) / sqrt(list_distance(x.c, y.c) * list_distance(x.c, y.c))) AS r
       FROM c x JOIN c y ON x.label <> y.label JOIN w wx ON wx.label = x.label JOIN w wy ON wy.label = y.label GROUP BY x.label),
b AS (SELECT sum(c.n * list_distance(c.c, grand.gm) * list_distance(c.c, grand.gm)) AS ssb, count(*) AS k FROM c, grand)
SELECT (SELECT {r('avg((b - a) / greatest(a, b))')} FROM s) AS silhouette_sq_euclidean,
       (SELECT {r('b.ssb * (t.n - b.k) / (t.ssw * (b.k - 1))')} FROM b, (SELECT sum(own) AS ssw, count(*) AS n FROM s) t) AS calinski_harabasz,
       (SELECT {r('avg(r)')} FROM db) AS davies_bouldin, (SELECT {r('sum(own)')} FROM s) AS inertia""")
def embedding_label_quality(spark, sf_dir):
    """Silhouette (squared Euclidean), CH, DB and inertia of the stored labels as a partition
    of the embedding space."""
    from kestrel.plans.testdata import table
    return canonical(ML.quality_row(table(spark, sf_dir, "embeddings"), "embedding", "label"))


@query("kmeans_invariants", """SELECT true AS nearest_centre, true AS sizes_add_up, CAST(3 AS BIGINT) AS n_clusters""")
def kmeans_invariants(spark, sf_dir):
    """What any fitted k-means must satisfy: every point is at its nearest centre, the cluster sizes
    add up to the points, and no cluster is empty."""
    vec = _vectors(spark, sf_dir)
    model, _ = ML.kmeans_best(vec, K)
    labelled = model.transform(vec)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    point = F.array(*[F.col(f).cast("double") for f in FEATURES])
    distance = F.transform(centres, lambda c: ML._sqdist(c, point))
    own = F.element_at(distance, F.col("raw_cluster") + 1)
    return canonical(labelled.agg(F.every(own <= F.array_min(distance) + 1e-9).alias("nearest_centre"),
                                  (F.count(F.lit(1)) == F.count("raw_cluster")).alias("sizes_add_up"),
                                  F.count_distinct("raw_cluster").alias("n_clusters")))


@query("pca_invariants", """SELECT true AS uncorrelated, true AS ordered_by_variance, true AS centred""")
def pca_invariants(spark, sf_dir):
    """What principal-component scores must satisfy: uncorrelated, ordered by variance, centred."""
    pcs = ML.pca_scores(_vectors(spark, sf_dir), 2)
    return pcs.agg((F.abs(F.corr("pc1", "pc2")) < 1e-6).alias("uncorrelated"), (F.var_pop("pc1") >= F.var_pop("pc2")).alias("ordered_by_variance"),
                   ((F.abs(F.avg("pc1")) < 1e-6) & (F.abs(F.avg("pc2")) < 1e-6)).alias("centred"))


@query("auto_k", None)
def auto_k(spark, sf_dir):
    """The k chosen when none is given: argmax of the silhouette over k = 2..6, with its table."""
    table = cut_lineage(ML.select_k(_vectors(spark, sf_dir), FEATURES))
    return canonical(table.withColumn("chosen", F.col("k") == ML.best_k(table)))


@query("model_manifest", None)
def model_manifest(spark, sf_dir):
    """The modelling run's manifest row: snapshot period, chosen k, silhouette, stability, entities."""
    vec = _vectors(spark, sf_dir)
    model, _, k = ML.kmeans_auto(vec, FEATURES)
    labelled = cut_lineage(model.transform(vec).select("entity", "period", *FEATURES, "features", "raw_cluster"))
    agreement = ML.stability(labelled, k, "raw_cluster", features=FEATURES).select(F.col("adjusted_rand").alias("stability_ari"), F.lit(1).alias("one"))
    quality = euclidean_silhouette(labelled, FEATURES, "raw_cluster").withColumn("one", F.lit(1))
    size = labelled.agg(F.max("period").alias("snapshot_period"), F.count(F.lit(1)).alias("n_entities")).withColumn("one", F.lit(1))
    return canonical(size.join(quality, "one").join(agreement, "one").withColumn("k", F.lit(k)).drop("one"))
