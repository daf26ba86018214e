"""Modelling-stage queries on the latest scored snapshot of the small panel.

For SQL-checkable label-dependent statistics the cluster label is the score tertile
(high → 0, middle → 1, low → 2), a deterministic partition; fitted-model queries live in
``q_ml`` and are compared on row counts only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import spec as S
from kestrel.operators import model as M
from kestrel.plans.catalog import query
from kestrel.session import cut_lineage
from kestrel.plans.output import canonical, r
from kestrel.plans.q_panel import features_panel
from kestrel.plans.sqltext import case_priority_action, case_slope, feature_ctes
from kestrel.plans.testdata import (CLUSTER_FEATURES, CONTEXT_METRIC, DEV_METRIC, METRICS, PANEL_CTE, SMALL_SPEC,
                                    TYPE_PREFIX, table)

SPEC = SMALL_SPEC
FEATURES = list(CLUSTER_FEATURES)
LABELS = {m.name: m.label for m in METRICS}
PROFILE_COLS = FEATURES + [CONTEXT_METRIC, SPEC.score_col]
K = 3
# Fixed expectation lists for the face-validity check on the test tables.
EXPECTED_HIGH = ["NATION_3", "NATION_8", "NATION_13", "NATION_18"]
EXPECTED_LOW = ["NATION_0", "NATION_5", "NATION_10", "NATION_15"]

LEVEL_TO_CLUSTER = {"tinggi": 0, "sedang": 1, "rendah": 2}


def model_frame(spark, sf_dir):
    feat = features_panel(spark, sf_dir)
    mf = M.model_frame(feat, SPEC, None, FEATURES, "group_name", TYPE_PREFIX)
    mf = M.add_tertile_level(mf, SPEC.score_col)
    mf = M.add_priority_action(mf)
    cluster = F.element_at(F.create_map(*[x for k, v in LEVEL_TO_CLUSTER.items() for x in (F.lit(k), F.lit(v))]),
                           F.col("vulnerability_level"))
    # The snapshot is reused by every downstream statistic: it is written once in the shared
    # folder (cuts lineage; survives executor loss).
    return cut_lineage(mf.withColumn("cluster_id", cluster.cast("int")))


MF_SQL = f"""WITH {PANEL_CTE},
{feature_ctes(SPEC)},
latest AS (SELECT max(CASE WHEN score IS NOT NULL THEN period END) AS t FROM feat),
slopes AS (SELECT entity, CASE WHEN count(m_ret) >= 3 THEN {r('regr_slope(m_ret, CAST(period AS DOUBLE))')} END AS trend_slope
           FROM feat JOIN latest ON period BETWEEN t - 5 AND t GROUP BY entity),
mf AS (SELECT f.*, s.trend_slope, {case_slope('s.trend_slope')} AS trend_label,
              CASE WHEN starts_with(group_name, '{TYPE_PREFIX}') THEN 'kota' ELSE 'kabupaten' END AS entity_type
       FROM feat f JOIN latest ON f.period = latest.t LEFT JOIN slopes s USING (entity)
       WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)}),
edges AS (SELECT quantile_cont(score, 1.0e0/3) AS e1, quantile_cont(score, 2.0e0/3) AS e2 FROM mf),
lv AS (SELECT mf.*, CASE WHEN score IS NULL THEN NULL WHEN score <= e1 THEN 'rendah' WHEN score <= e2 THEN 'sedang'
                    ELSE 'tinggi' END AS vulnerability_level FROM mf JOIN edges ON TRUE),
cl AS (SELECT lv.*, CASE vulnerability_level WHEN 'tinggi' THEN 0 WHEN 'sedang' THEN 1 WHEN 'rendah' THEN 2 END AS cluster_id,
              {case_priority_action('vulnerability_level', 'trend_label')} AS priority_action FROM lv)"""


@query("trend_slope", f"{MF_SQL}\nSELECT entity, trend_slope FROM slopes")
def trend_slope(spark, sf_dir):
    """OLS slope of the trend metric over the 6 periods ending at the latest scored one."""
    return canonical(M.trend_slope(features_panel(spark, sf_dir), SPEC, None))


@query("slope_label", f"{MF_SQL}\nSELECT entity, trend_slope, {case_slope('trend_slope')} AS trend_label FROM slopes")
def slope_label(spark, sf_dir):
    from kestrel.functions.labels import slope_label as label
    s = M.trend_slope(features_panel(spark, sf_dir), SPEC, None)
    return canonical(s.withColumn("trend_label", label("trend_slope")))


@query("model_frame", f"""{MF_SQL}
SELECT entity, entity_name, period, {', '.join(f'{r(c)} AS {c}' for c in FEATURES)}, {r('score')} AS score,
       trend_slope, trend_label, entity_type FROM mf""")
def model_frame_q(spark, sf_dir):
    mf = M.model_frame(features_panel(spark, sf_dir), SPEC, None, FEATURES, "group_name", TYPE_PREFIX)
    return canonical(mf.select("entity", "entity_name", "period", *FEATURES, "score", "trend_slope",
                               "trend_label", "entity_type"))


@query("tertile_level", f"{MF_SQL}\nSELECT entity, {r('score')} AS score, vulnerability_level FROM lv")
def tertile_level(spark, sf_dir):
    """Quantile cut of the score into three levels (exact linear edges at 1/3 and 2/3)."""
    return canonical(model_frame(spark, sf_dir).select("entity", "score", "vulnerability_level"))


@query("priority_action", f"{MF_SQL}\nSELECT entity, vulnerability_level, trend_label, priority_action FROM cl")
def priority_action(spark, sf_dir):
    return model_frame(spark, sf_dir).select("entity", "vulnerability_level", "trend_label", "priority_action")


_LEVEL_ORD = " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(S.LEVEL_ORDER, 1))
_TREND_ORD = " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(S.TREND_ORDER, 1))


@query("priority_matrix", f"""{MF_SQL},
cells AS (SELECT vulnerability_level, trend_label, count(*) AS n_entities FROM cl GROUP BY ALL),
cc AS (SELECT vulnerability_level, trend_label, cluster_id, count(*) AS cnt FROM cl GROUP BY 1, 2, 3),
modes AS (SELECT vulnerability_level, trend_label, cluster_id FROM (
  SELECT vulnerability_level, trend_label, cluster_id,
         row_number() OVER (PARTITION BY vulnerability_level, trend_label ORDER BY cnt DESC, cluster_id) AS rn
  FROM cc) x WHERE rn = 1)
SELECT c.vulnerability_level, c.trend_label, c.n_entities, CAST(m.cluster_id AS BIGINT) AS dominant_cluster_id,
       {case_priority_action('c.vulnerability_level', 'c.trend_label')} AS priority_action,
       CAST((CASE c.vulnerability_level {_LEVEL_ORD} END) * 10 + (CASE c.trend_label {_TREND_ORD} END) AS BIGINT) AS cell_order
FROM cells c JOIN modes m USING (vulnerability_level, trend_label)""")
def priority_matrix(spark, sf_dir):
    """Level x trend matrix: action, size, modal cluster (smallest on tie)."""
    return canonical(M.priority_matrix(model_frame(spark, sf_dir)))


@query("priority_members", f"""{MF_SQL}
SELECT vulnerability_level, trend_label, entity_name AS member FROM cl""")
def priority_members(spark, sf_dir):
    """Members of every cell of the priority matrix, one row each."""
    return M.group_members(model_frame(spark, sf_dir), ["vulnerability_level", "trend_label"], "entity_name")


@query("cluster_members", f"""{MF_SQL}
SELECT CAST(cluster_id AS BIGINT) AS cluster_id, entity_name AS member FROM cl""")
def cluster_members(spark, sf_dir):
    """Members of every cluster, one row each."""
    return canonical(M.group_members(model_frame(spark, sf_dir), ["cluster_id"], "entity_name"))


_TIER = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(S.TIER_NAMES_K3))


@query("cluster_profiles", f"""{MF_SQL},
th AS (SELECT quantile_cont({DEV_METRIC}, 0.33) AS dl, quantile_cont({DEV_METRIC}, 0.67) AS dh,
              quantile_cont(m_ret, 0.33) AS pl, quantile_cont(m_ret, 0.67) AS ph FROM cl),
p AS (SELECT cluster_id, count(*) AS n_entities, count_if(entity_type = 'kota') AS n_city,
             count_if(entity_type = 'kabupaten') AS n_regency,
             {', '.join(f'avg({c}) AS a_{c}' for c in PROFILE_COLS)} FROM cl GROUP BY cluster_id)
SELECT CAST(cluster_id AS BIGINT) AS cluster_id, CASE cluster_id {_TIER} END AS tier,
       CASE WHEN a_{DEV_METRIC} >= dh AND a_m_ret <= pl THEN '{S.ARCHETYPE_URBAN}'
            WHEN a_{DEV_METRIC} <= dl AND a_m_ret >= ph THEN '{S.ARCHETYPE_RURAL}' ELSE '{S.ARCHETYPE_MIXED}' END AS archetype,
       n_entities, n_city, n_regency, {', '.join(f'{r("a_" + c)} AS mean_{c}' for c in PROFILE_COLS)}
FROM p JOIN th ON TRUE""")
def cluster_profiles(spark, sf_dir):
    mf = model_frame(spark, sf_dir)
    return canonical(M.cluster_profiles(mf, K, PROFILE_COLS, DEV_METRIC, "m_ret"))


def _anova_sql(f):
    return f"""SELECT '{f}' AS feature, '{LABELS[f]}' AS label,
  {r(f"CASE WHEN sst > 0 THEN ssb / sst ELSE 0 END")} AS eta_squared,
  {r("(ssb / (g - 1)) / NULLIF(ssw / (n - g), 0)")} AS anova_f
FROM (SELECT sum(nc * (mc - mu) * (mc - mu)) AS ssb, sum(sswc) AS ssw, max(sst) AS sst, max(n) AS n, count_if(nc > 0) AS g
      FROM (SELECT cluster_id, count({f}) AS nc, avg({f}) AS mc, coalesce(var_pop({f}), 0) * count({f}) AS sswc FROM cl GROUP BY cluster_id) c
      JOIN (SELECT avg({f}) AS mu, var_pop({f}) * count({f}) AS sst, count({f}) AS n FROM cl) t ON TRUE) x"""


@query("feature_importance", MF_SQL + "\n" + "\nUNION ALL\n".join(_anova_sql(f) for f in FEATURES))
def feature_importance(spark, sf_dir):
    """eta squared and one-way ANOVA F of each clustering feature across clusters."""
    return canonical(M.anova(model_frame(spark, sf_dir), FEATURES, labels=LABELS, with_p=False)).orderBy(F.desc("eta_squared"), "feature")


def _anova_p_sql(f):
    # with k = 3 clusters the F tail has a closed form: (1 + 2 F / d2) ** (-d2 / 2)
    return f"""SELECT feature, label, eta_squared, anova_f, round_even(power(1 + 2 * f / (n - g), -(n - g) / 2.0e0) * 1000000e0, 0) / 1000000e0 AS anova_p
FROM (SELECT '{f}' AS feature, '{LABELS[f]}' AS label, {r("CASE WHEN sst > 0 THEN ssb / sst ELSE 0 END")} AS eta_squared,
        {r("(ssb / (g - 1)) / NULLIF(ssw / (n - g), 0)")} AS anova_f, (ssb / (g - 1)) / NULLIF(ssw / (n - g), 0) AS f, n, g
  FROM (SELECT sum(nc * (mc - mu) * (mc - mu)) AS ssb, sum(sswc) AS ssw, max(sst) AS sst, max(n) AS n, count_if(nc > 0) AS g
      FROM (SELECT cluster_id, count({f}) AS nc, avg({f}) AS mc, coalesce(var_pop({f}), 0) * count({f}) AS sswc FROM cl GROUP BY cluster_id) c
      JOIN (SELECT avg({f}) AS mu, var_pop({f}) * count({f}) AS sst, count({f}) AS n FROM cl) t ON TRUE) x) y"""


@query("feature_importance_p", MF_SQL + "\n" + "\nUNION ALL\n".join(_anova_p_sql(f) for f in FEATURES))
def feature_importance_p(spark, sf_dir):
    """Same with the ANOVA p-value (F tail)."""
    return canonical(M.anova(model_frame(spark, sf_dir), FEATURES, labels=LABELS, with_p=True), 6)


def _effect_sql(f, g, a, b):
    return f"""SELECT '{f}' AS feature, '{LABELS[f]}' AS label, {r('ma')} AS mean_{a}, {r('mb')} AS mean_{b},
  {r("CASE WHEN na < 2 OR nb < 2 THEN NULL WHEN sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)) = 0 THEN 0.0e0 ELSE (ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)) END")} AS cohens_d
FROM (SELECT count({f}) FILTER (WHERE {g} = '{a}') AS na, avg({f}) FILTER (WHERE {g} = '{a}') AS ma, var_samp({f}) FILTER (WHERE {g} = '{a}') AS va,
             count({f}) FILTER (WHERE {g} = '{b}') AS nb, avg({f}) FILTER (WHERE {g} = '{b}') AS mb, var_samp({f}) FILTER (WHERE {g} = '{b}') AS vb
      FROM cl) x"""


@query("effect_size", MF_SQL + "\n" + "\nUNION ALL\n".join(
    _effect_sql(f, "entity_type", "kota", "kabupaten") for f in FEATURES + [CONTEXT_METRIC]))
def effect_size(spark, sf_dir):
    """Cohen's d (pooled, ddof=1) between the two administrative types, per feature."""
    out = M.two_group_stats(model_frame(spark, sf_dir), "entity_type", "kota", "kabupaten",
                            FEATURES + [CONTEXT_METRIC], LABELS, with_p=False)
    return canonical(out)


def _welch_sql(f, g, a, b, frame="cl"):
    """The tail of Student's t by Simpson's rule: with x = sqrt(df) tan(u) its density is a power of cos(u)."""
    return f"""SELECT '{f}' AS feature, '{LABELS[f]}' AS label, {r('ma')} AS mean_{a}, {r('mb')} AS mean_{b}, d AS cohens_d,
  CASE WHEN na >= 2 AND nb >= 2 AND df > 0 THEN {r('1 - 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi()) * u / 6000 * s', 6)} END AS welch_p
FROM (SELECT *, list_sum(list_transform(range(0, 2001), lambda i: (CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * power(cos(i * u / 2000), df - 1))) AS s
  FROM (SELECT *, atan(abs(ma - mb) / sqrt(e) / sqrt(df)) AS u FROM (SELECT *, va / na + vb / nb AS e, power(va / na + vb / nb, 2) / (power(va / na, 2) / (na - 1) + power(vb / nb, 2) / (nb - 1)) AS df
    FROM (SELECT *, CASE WHEN na < 2 OR nb < 2 THEN NULL WHEN sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)) = 0 THEN 0.0e0 ELSE {r('(ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2))')} END AS d
      FROM (SELECT count({f}) FILTER (WHERE {g} = '{a}') AS na, avg({f}) FILTER (WHERE {g} = '{a}') AS ma, var_samp({f}) FILTER (WHERE {g} = '{a}') AS va,
             count({f}) FILTER (WHERE {g} = '{b}') AS nb, avg({f}) FILTER (WHERE {g} = '{b}') AS mb, var_samp({f}) FILTER (WHERE {g} = '{b}') AS vb
            FROM {frame}) v) w) x) y) z"""


ARCHETYPE_SQL = f"""{MF_SQL},
th AS (SELECT quantile_cont({DEV_METRIC}, 0.33) AS dl, quantile_cont({DEV_METRIC}, 0.67) AS dh,
              quantile_cont(m_ret, 0.33) AS pl, quantile_cont(m_ret, 0.67) AS ph FROM cl),
pr AS (SELECT cluster_id, avg({DEV_METRIC}) AS a, avg(m_ret) AS b FROM cl GROUP BY cluster_id),
ar AS (SELECT cl.*, CASE WHEN a >= dh AND b <= pl THEN '{S.ARCHETYPE_URBAN}' WHEN a <= dl AND b >= ph THEN '{S.ARCHETYPE_RURAL}' ELSE '{S.ARCHETYPE_MIXED}' END AS archetype
       FROM cl JOIN pr USING (cluster_id) JOIN th ON TRUE)"""


@query("administrative_comparison", MF_SQL + "\n" + "\nUNION ALL\n".join(
    _welch_sql(f, "entity_type", "kota", "kabupaten") for f in FEATURES + [CONTEXT_METRIC]))
def administrative_comparison(spark, sf_dir):
    """Means, Cohen's d and Welch p between the two administrative types."""
    return canonical(M.two_group_stats(model_frame(spark, sf_dir), "entity_type", "kota", "kabupaten", FEATURES + [CONTEXT_METRIC], LABELS), 6)


@query("two_group_comparison", ARCHETYPE_SQL + "\n" + "\nUNION ALL\n".join(
    _welch_sql(f, "archetype", S.ARCHETYPE_URBAN, S.ARCHETYPE_RURAL, "ar") for f in FEATURES + [CONTEXT_METRIC]))
def two_group_comparison(spark, sf_dir):
    """Urban vs rural archetype: means, Cohen's d and Welch p, largest |d| first."""
    mf = model_frame(spark, sf_dir)
    prof = M.cluster_profiles(mf, K, PROFILE_COLS, DEV_METRIC, "m_ret")
    labelled = M.attach_cluster_labels(mf, prof)
    out = M.two_group_stats(labelled, "archetype", S.ARCHETYPE_URBAN, S.ARCHETYPE_RURAL,
                            FEATURES + [CONTEXT_METRIC], LABELS, with_p=True)
    return canonical(out, 6).orderBy(F.abs("cohens_d").desc_nulls_last(), "feature")


@query("adjusted_rand", """
WITH c AS (SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL),
s AS (SELECT sum(n * (n - 1) / 2) AS sij, sum(n) AS total FROM c),
a AS (SELECT sum(n * (n - 1) / 2) AS sa FROM (SELECT quality, sum(n) AS n FROM c GROUP BY quality) x),
b AS (SELECT sum(n * (n - 1) / 2) AS sb FROM (SELECT toxic, sum(n) AS n FROM c GROUP BY toxic) y)
SELECT round_even(CAST(CASE WHEN (sa + sb) / 2 = sa * sb / (total * (total - 1) / 2) THEN 1.0e0
  ELSE (sij - sa * sb / (total * (total - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (total * (total - 1) / 2)) END AS DOUBLE) * 10000e0, 0) / 10000e0 AS adjusted_rand,
  CAST(total AS BIGINT) AS n
FROM s, a, b""")
def adjusted_rand(spark, sf_dir):
    """Agreement between two labelings of the labelled documents (quality vs toxicity)."""
    return canonical(M.adjusted_rand(table(spark, sf_dir, "labels"), "quality", "toxic"))


@query("cluster_composition", f"""{MF_SQL}
SELECT CASE cluster_id {_TIER} END AS tier, entity_type, count(*) AS n_entities FROM cl GROUP BY ALL""")
def cluster_composition(spark, sf_dir):
    from kestrel.functions.labels import tier_name
    mf = model_frame(spark, sf_dir).withColumn("tier", tier_name("cluster_id", K))
    return mf.groupBy("tier", "entity_type").agg(F.count(F.lit(1)).alias("n_entities"))


@query("expectation_check", f"""{MF_SQL}
SELECT count_if(entity_name IN ({', '.join(repr(x) for x in EXPECTED_HIGH)}) AND cluster_id = 0) AS high_hits,
       count_if(entity_name IN ({', '.join(repr(x) for x in EXPECTED_LOW)}) AND cluster_id = {K - 1}) AS low_hits,
       (count_if(entity_name IN ({', '.join(repr(x) for x in EXPECTED_HIGH)}) AND cluster_id = 0) >= 2 AND
        count_if(entity_name IN ({', '.join(repr(x) for x in EXPECTED_LOW)}) AND cluster_id = {K - 1}) >= 2) AS passed FROM cl""")
def expectation_check(spark, sf_dir):
    return M.expectation_check(model_frame(spark, sf_dir), "entity_name", "cluster_id", EXPECTED_HIGH, EXPECTED_LOW, K)


_NAMES = ", ".join([f"('high', '{n}', 0)" for n in EXPECTED_HIGH] + [f"('low', '{n}', {K - 1})" for n in EXPECTED_LOW])


@query("expectation_names", f"""{MF_SQL}
SELECT w.side, w.name, EXISTS (SELECT 1 FROM cl WHERE cl.entity_name = w.name AND cl.cluster_id = w.want) AS hit
FROM (VALUES {_NAMES}) w(side, name, want)""")
def expectation_names(spark, sf_dir):
    """The expected names of the face-validity check, found and not found."""
    return M.expectation_names(model_frame(spark, sf_dir), "entity_name", "cluster_id", EXPECTED_HIGH, EXPECTED_LOW, K)


@query("relabel_clusters", f"""{MF_SQL},
raw AS (SELECT entity, entity % 3 AS raw_cluster, score FROM cl),
m AS (SELECT raw_cluster, avg(score) AS ms FROM raw GROUP BY raw_cluster),
o AS (SELECT raw_cluster, row_number() OVER (ORDER BY ms DESC NULLS LAST, raw_cluster) - 1 AS cluster_id FROM m)
SELECT entity, raw_cluster, CAST(cluster_id AS BIGINT) AS cluster_id FROM raw JOIN o USING (raw_cluster)""")
def relabel_clusters(spark, sf_dir):
    """Arbitrary raw labels renamed so 0 has the highest mean score."""
    mf = model_frame(spark, sf_dir).select("entity", (F.col("entity") % 3).alias("raw_cluster"), "score")
    return canonical(M.relabel_by_score(mf, "raw_cluster", "score").select("entity", "raw_cluster", "cluster_id"))


@query("cluster_z_profile", f"""{MF_SQL},
z AS (SELECT cluster_id, {', '.join(f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0e0 ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS {c}" for c in FEATURES)} FROM cl)
SELECT CAST(cluster_id AS BIGINT) AS cluster_id, {', '.join(f'{r(f"avg({c})")} AS {c}' for c in FEATURES)} FROM z GROUP BY cluster_id""")
def cluster_z_profile(spark, sf_dir):
    """Mean standardised feature value per cluster."""
    from kestrel.operators.ml import standardize
    z = standardize(model_frame(spark, sf_dir), FEATURES)
    return canonical(z.groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in FEATURES]))


@query("entity_type", f"{MF_SQL}\nSELECT entity, group_name, entity_type FROM mf")
def entity_type_q(spark, sf_dir):
    """Administrative type from the name prefix rule (on the region name here)."""
    mf = M.model_frame(features_panel(spark, sf_dir), SPEC, None, FEATURES, "group_name", TYPE_PREFIX)
    return mf.select("entity", "group_name", "entity_type")


_TIER5 = "CASE WHEN cluster_id = 0 THEN 'kerentanan_tertinggi' WHEN cluster_id = 4 THEN 'kerentanan_terendah' " \
         "ELSE 'kerentanan_menengah_' || CAST(cluster_id AS VARCHAR) END"


@query("cluster_tier", f"""{MF_SQL}
SELECT entity, CAST(cluster_id AS BIGINT) AS cluster_id, CASE cluster_id {_TIER} END AS tier_k3, {_TIER5} AS tier_k5 FROM cl""")
def cluster_tier(spark, sf_dir):
    """Tier names of cluster ids for k = 3 (fixed names) and for another k (ranked names)."""
    from kestrel.functions.labels import tier_name
    mf = model_frame(spark, sf_dir)
    return canonical(mf.select("entity", "cluster_id", tier_name("cluster_id", 3).alias("tier_k3"),
                               tier_name("cluster_id", 5).alias("tier_k5")))
