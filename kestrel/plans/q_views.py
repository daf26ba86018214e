"""Report and dashboard views over the scored panel and the model frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.numeric import round_half_even

from kestrel import spec as S
from kestrel.functions import text as T
from kestrel.operators import model as M
from kestrel.operators import validate as V
from kestrel.operators import views as VW
from kestrel.plans.catalog import query
from kestrel.plans.output import canonical, r
from kestrel.plans.q_model import (CONTEXT_METRIC, DEV_METRIC, FEATURES, K, LABELS, MF_SQL, PROFILE_COLS, SPEC,
                                   _effect_sql, model_frame)
from kestrel.plans.q_panel import features_panel
from kestrel.plans.sqltext import feature_ctes
from kestrel.plans.testdata import PANEL_CTE, table

FEAT = f"WITH {PANEL_CTE},\n{feature_ctes(SPEC)}"
_TIER = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(S.TIER_NAMES_K3))
_MEANS = [f"mean_{c}" for c in FEATURES]


def _profiles(frame):
    return M.cluster_profiles(frame, K, PROFILE_COLS, DEV_METRIC, "m_ret")


_PROFILE_SQL = f"""{MF_SQL},
p AS (SELECT cluster_id, {', '.join(f'avg({c}) AS mean_{c}' for c in FEATURES)} FROM cl GROUP BY cluster_id)"""


@query("unpivot_metrics", f"""{_PROFILE_SQL}
SELECT tier, indicator, {r('value')} AS value FROM (
  SELECT CASE cluster_id {_TIER} END AS tier, {', '.join(_MEANS)} FROM p)
  UNPIVOT INCLUDE NULLS (value FOR indicator IN ({', '.join(_MEANS)}))""")
def unpivot_metrics(spark, sf_dir):
    """Cluster mean profile melted to (tier, indicator, value), nulls kept."""
    prof = _profiles(model_frame(spark, sf_dir)).select("tier", *_MEANS)
    return canonical(VW.melt(prof, ["tier"], _MEANS))


_TRENDS = ["membaik", "stabil", "memburuk"]


@query("pivot_priority", f"""{MF_SQL}
SELECT vulnerability_level, {', '.join(f"count_if(trend_label = '{t}') AS {t}" for t in _TRENDS)}
FROM cl WHERE vulnerability_level IN ('tinggi', 'sedang', 'rendah') GROUP BY vulnerability_level""")
def pivot_priority(spark, sf_dir):
    """Level x trend entity counts (fixed columns, missing cells 0)."""
    return VW.pivot_counts(model_frame(spark, sf_dir), "vulnerability_level", "trend_label", _TRENDS,
                           list(S.LEVEL_ORDER))


_PERIODS = list(range(SPEC.period_start, SPEC.period_end + 1))


@query("pivot_coverage", f"""{FEAT},
cov AS (SELECT period, {', '.join(f'count({m}) AS {m}' for m in SPEC.metric_names)} FROM feat GROUP BY period),
long AS (UNPIVOT cov ON {', '.join(SPEC.metric_names)} INTO NAME indicator VALUE n)
SELECT indicator, {', '.join(f'max(n) FILTER (WHERE period = {p}) AS "{p}"' for p in _PERIODS)} FROM long GROUP BY indicator""")
def pivot_coverage(spark, sf_dir):
    """Indicator x period coverage table."""
    cov = V.coverage_by_period(features_panel(spark, sf_dir), SPEC)
    long = VW.melt(cov, ["period"], SPEC.metric_names, "indicator", "n")
    return canonical(VW.pivot_values(long, "indicator", "period", "n", _PERIODS))


@query("minmax_profile", f"""{_PROFILE_SQL}
SELECT CASE cluster_id {_TIER} END AS tier, {', '.join(f"{r(f'(mean_{c} - min(mean_{c}) OVER ()) / NULLIF(max(mean_{c}) OVER () - min(mean_{c}) OVER (), 0)')} AS mean_{c}" for c in FEATURES)}
FROM p""")
def minmax_profile(spark, sf_dir):
    """Cluster means rescaled to 0..1 per indicator (constant indicator → null)."""
    frame = model_frame(spark, sf_dir)
    prof = _profiles(frame)
    raw = frame.groupBy("cluster_id").agg(*[F.avg(c).alias(f"mean_{c}") for c in FEATURES])
    tiers = prof.select("cluster_id", "tier")
    out = VW.minmax_normalize(raw, _MEANS).join(tiers, "cluster_id")
    return canonical(out.select("tier", *_MEANS))


@query("effect_view", f"""{MF_SQL},
e AS ({' UNION ALL '.join(_effect_sql(f, 'entity_type', 'kota', 'kabupaten') for f in FEATURES + [CONTEXT_METRIC])})
SELECT feature, label, cohens_d, abs(cohens_d) AS strength,
       CASE WHEN cohens_d > 0 THEN '{VW.SIDE_A}' ELSE '{VW.SIDE_B}' END AS side FROM e""")
def effect_view(spark, sf_dir):
    eff = M.two_group_stats(model_frame(spark, sf_dir), "entity_type", "kota", "kabupaten",
                            FEATURES + [CONTEXT_METRIC], LABELS, with_p=False)
    return canonical(VW.effect_view(eff.select("feature", "label", "cohens_d")))


@query("headline_kpis", f"""{FEAT},
yt AS (SELECT period, {r('avg(m_ret)')} AS m_ret, {r('avg(score)')} AS score FROM feat GROUP BY period),
l AS (SELECT * FROM yt ORDER BY period DESC LIMIT 1),
p AS (SELECT * FROM yt WHERE period < (SELECT period FROM l) ORDER BY period DESC LIMIT 1)
SELECT l.period, p.period AS previous_period, {r('l.m_ret')} AS m_ret, {r('l.m_ret - p.m_ret')} AS m_ret_delta,
       {r('l.score')} AS score, {r('l.score - p.score')} AS score_delta FROM l LEFT JOIN p ON TRUE""")
def headline_kpis(spark, sf_dir):
    """Latest-period means with the change from the previous period."""
    feat = features_panel(spark, sf_dir)
    yt = feat.groupBy("period").agg(round_half_even(F.avg("m_ret"), 4).alias("m_ret"), round_half_even(F.avg("score"), 4).alias("score"))
    return canonical(VW.latest_and_previous(yt, "period", ["m_ret", "score"]))


@query("urgent_count", f"""{MF_SQL}
SELECT count_if(priority_action = '{S.URGENT_ACTION}') AS urgent_entities, count(*) AS entities FROM cl""")
def urgent_count(spark, sf_dir):
    mf = model_frame(spark, sf_dir)
    return mf.agg(F.count_if(F.col("priority_action") == S.URGENT_ACTION).alias("urgent_entities"),
                  F.count(F.lit(1)).alias("entities"))


_ACTIONS = ("prioritas_segera", "intervensi_intensif", "peringatan_dini")


@query("urgent_list", f"""{MF_SQL}
SELECT row_number() OVER (ORDER BY score DESC, entity) AS order_no, entity, entity_name, {r('score')} AS score, priority_action
FROM cl WHERE priority_action IN {_ACTIONS}""")
def urgent_list(spark, sf_dir):
    """Entities needing action, by score, numbered 1..n."""
    mf = model_frame(spark, sf_dir).where(F.col("priority_action").isin(*_ACTIONS))
    out = VW.global_ordinal(mf, "score", "entity")
    return canonical(out.select("order_no", "entity", "entity_name", "score", "priority_action"))


@query("priority_preview", f"""{FEAT},
l AS (SELECT max(CASE WHEN score IS NOT NULL THEN period END) AS t FROM feat)
SELECT entity, entity_name, CAST(priority_rank AS BIGINT) AS priority_rank, {r('score')} AS score, priority_bucket
FROM feat JOIN l ON period = t WHERE score IS NOT NULL ORDER BY priority_rank, entity LIMIT 10""")
def priority_preview(spark, sf_dir):
    """Top 10 of the latest scored period by rank (a top-k report)."""
    from kestrel.operators import panel as P
    snap = P.cross_section(features_panel(spark, sf_dir), SPEC, latest=True).where(F.col("score").isNotNull())
    out = snap.orderBy("priority_rank", "entity").limit(10)
    return canonical(out.select("entity", "entity_name", "priority_rank", "score", "priority_bucket"))


@query("score_ranking", f"""{MF_SQL}
SELECT entity, entity_name, {r('score')} AS score, vulnerability_level FROM cl""")
def score_ranking(spark, sf_dir):
    """Snapshot scores in ascending order (range-partitioned sort at the sink)."""
    return canonical(model_frame(spark, sf_dir).select("entity", "entity_name", "score", "vulnerability_level")
                     .orderBy("score", "entity"))


@query("region_series", f"""{FEAT}
SELECT entity, entity_name, period, {r('m_ret')} AS m_ret, {r('score')} AS score FROM feat
WHERE group_name IN ('AMERICA', 'ASIA') AND period BETWEEN 1996 AND 2000""")
def region_series(spark, sf_dir):
    """Per-entity series for a chosen group of regions and a period range."""
    out = VW.members_filter(features_panel(spark, sf_dir), "group_name", ["AMERICA", "ASIA"], "period", 1996, 2000)
    return canonical(out.select("entity", "entity_name", "period", "m_ret", "score"))


@query("region_period_filter", f"""{MF_SQL}
SELECT entity, priority_action FROM cl WHERE priority_action IN {_ACTIONS}""")
def region_period_filter(spark, sf_dir):
    """Action filter of the vulnerability view."""
    return VW.members_filter(model_frame(spark, sf_dir), "priority_action", list(_ACTIONS)).select("entity", "priority_action")


@query("distinct_entities", """
SELECT DISTINCT n_name AS entity_name FROM nation WHERE n_name IS NOT NULL""")
def distinct_entities(spark, sf_dir):
    """Sorted distinct entity names for selection lists."""
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("entity_name")).where(
        F.col("entity_name").isNotNull()).distinct().orderBy("entity_name")


def _title_sql(x: str) -> str:
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


@query("display_name", f"""
SELECT p_partkey, replace({_title_sql('lower(p_type)')} || '-' || {_title_sql('p_name')} || '_X', '_', ' ') AS display
FROM part""")
def display_name(spark, sf_dir):
    """Display strings: title case after any non-letter, underscores as spaces."""
    part = table(spark, sf_dir, "part")
    raw = F.concat(F.lower("p_type"), F.lit("-"), F.col("p_name"), F.lit("_x"))
    return part.select("p_partkey", T.underscores_to_spaces(T.display_name(raw)).alias("display"))


@query("cluster_composition_pct", f"""{MF_SQL}
SELECT entity_type, count(*) AS n_entities, {r('100.0e0 * count(*) / sum(count(*)) OVER ()')} AS share FROM cl GROUP BY entity_type""")
def cluster_composition_pct(spark, sf_dir):
    """Administrative-type shares of the snapshot."""
    mf = model_frame(spark, sf_dir)
    g = mf.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n_entities"))
    tot = mf.agg(F.count(F.lit(1)).alias("__t"))
    j = VW.join_small(g.withColumn("__one", F.lit(1)), tot.withColumn("__one", F.lit(1)), "__one", "inner", bound=1)
    return canonical(j.select("entity_type", "n_entities", (F.lit(100.0) * F.col("n_entities") / F.col("__t")).alias("share")))
