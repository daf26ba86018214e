"""Panel feature queries (flagship slice): change, rolling, z-scores, score, ranks, buckets."""

from __future__ import annotations

from kestrel.operators import features as FT
from kestrel.plans.catalog import query
from kestrel.session import cut_lineage
from kestrel.plans.output import canonical, r
from kestrel.plans.sqltext import case_trend, feature_ctes, feature_select, zscore
from kestrel.plans.testdata import LARGE_PANEL_CTE, LARGE_SPEC, PANEL_CTE, SMALL_SPEC, large_panel, small_panel

SPEC = SMALL_SPEC


def features_panel(spark, sf_dir, rank_strategy="distinct", processed=True):
    """The processed panel. Later stages (validation, exploration, modelling) read it many
    times, so it is written once, partitioned by period, like the processed panel file of a batch
    pipeline: queries on one period read that period alone."""
    out = FT.add_features(small_panel(spark, sf_dir), SPEC, rank_strategy=rank_strategy, materialize=not processed)
    return cut_lineage(out, SPEC.period) if processed else out


FEATURES_SQL = f"""WITH {PANEL_CTE},
{feature_ctes(SPEC)}
SELECT {feature_select(SPEC, extra=['entity_name', 'group_name'])} FROM feat"""


@query("priority_rank", FEATURES_SQL)
def priority_rank(spark, sf_dir):
    """Flagship: panel build + every feature of the scrub stage."""
    return canonical(features_panel(spark, sf_dir, processed=False))


@query("yoy_change", f"""WITH {PANEL_CTE}
SELECT entity, period, {', '.join(f"{r(m + ' - lag(' + m + ') OVER (PARTITION BY entity ORDER BY period)')} AS {m}_yoy_change" for m in SPEC.metric_names)}
FROM panel""")
def yoy_change(spark, sf_dir):
    df = FT.add_changes(small_panel(spark, sf_dir), SPEC)
    return canonical(df.select("entity", "period", *[f"{m}_yoy_change" for m in SPEC.metric_names]))


@query("yoy_pct_change", f"""WITH {PANEL_CTE}
SELECT entity, period, {', '.join(f"{r('(' + m + ' - lag(' + m + ') OVER w) / NULLIF(lag(' + m + ') OVER w, 0) * 100')} AS {m}_yoy_pct_change" for m in SPEC.metric_names)}
FROM panel WINDOW w AS (PARTITION BY entity ORDER BY period)""")
def yoy_pct_change(spark, sf_dir):
    df = FT.add_changes(small_panel(spark, sf_dir), SPEC)
    return canonical(df.select("entity", "period", *[f"{m}_yoy_pct_change" for m in SPEC.metric_names]))


@query("rolling_mean_3", f"""WITH {PANEL_CTE}
SELECT entity, period, {r('avg(m_ret) OVER (PARTITION BY entity ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')} AS m_ret_rolling_3,
       {r('avg(m_tax) OVER (PARTITION BY entity ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')} AS m_tax_rolling_3
FROM panel""")
def rolling_mean_3(spark, sf_dir):
    df = FT.add_rolling_mean(small_panel(spark, sf_dir), SPEC, "m_ret")
    df = FT.add_rolling_mean(df, SPEC, "m_tax")
    return canonical(df.select("entity", "period", "m_ret_rolling_3", "m_tax_rolling_3"))


@query("trend_direction", f"""WITH {PANEL_CTE}
SELECT entity, period, {case_trend('m_ret - lag(m_ret) OVER (PARTITION BY entity ORDER BY period)')} AS trend_direction
FROM panel""")
def trend_direction(spark, sf_dir):
    return FT.add_trend_direction(small_panel(spark, sf_dir), SPEC).select("entity", "period", "trend_direction")


@query("zscore_within_period", f"""WITH {PANEL_CTE}
SELECT entity, period, {', '.join(f"{r(zscore(m))} AS {m}_z" for m in SPEC.metric_names)} FROM panel""")
def zscore_within_period(spark, sf_dir):
    df = FT.add_zscores(small_panel(spark, sf_dir), SPEC)
    return canonical(df.select("entity", "period", *[f"{m}_z" for m in SPEC.metric_names]))


@query("risk_z", f"""WITH {PANEL_CTE}
SELECT entity, period, {', '.join(f"{r(('-' if m.risk == 'low_is_risky' else '') + '(' + zscore(m.name) + ')')} AS {m.name}_risk_z" for m in SPEC.risk_metrics)} FROM panel""")
def risk_z(spark, sf_dir):
    df = FT.add_risk_zscores(small_panel(spark, sf_dir), SPEC)
    return canonical(df.select("entity", "period", *[f"{m.name}_risk_z" for m in SPEC.risk_metrics]))


@query("composite_score", f"""WITH {PANEL_CTE},
{feature_ctes(SPEC)}
SELECT entity, period, n_score_components, {r('score')} AS score FROM feat""")
def composite_score(spark, sf_dir):
    df = FT.add_composite_score(FT.add_risk_zscores(small_panel(spark, sf_dir), SPEC), SPEC)
    return canonical(df.select("entity", "period", "n_score_components", "score"))


@query("pct_rank_min", f"""WITH {PANEL_CTE},
{feature_ctes(SPEC)}
SELECT entity, period, {r("CASE WHEN score IS NOT NULL THEN rank() OVER (PARTITION BY period ORDER BY score DESC NULLS LAST) / count(score) OVER (PARTITION BY period) END", 6)} AS priority_pct
FROM feat""")
def pct_rank_min(spark, sf_dir):
    df = FT.add_composite_score(FT.add_risk_zscores(small_panel(spark, sf_dir), SPEC), SPEC)
    df = FT.add_ranks(df, SPEC)
    return canonical(df.select("entity", "period", "priority_pct"), 6)


@query("priority_bucket", f"""WITH {PANEL_CTE},
{feature_ctes(SPEC)}
SELECT entity, period, priority_bucket FROM feat""")
def priority_bucket(spark, sf_dir):
    return features_panel(spark, sf_dir).select("entity", "period", "priority_bucket")


@query("row_reductions", f"""WITH {PANEL_CTE},
{feature_ctes(SPEC)}
SELECT entity, period, n_score_components, n_imputed, n_available FROM feat""")
def row_reductions(spark, sf_dir):
    df = features_panel(spark, sf_dir)
    return canonical(df.select("entity", "period", "n_score_components", "n_imputed", "n_available"))


LARGE_FEATURES_SQL = f"""WITH {LARGE_PANEL_CTE},
{feature_ctes(LARGE_SPEC)}
SELECT {feature_select(LARGE_SPEC)} FROM feat"""


@query("priority_rank_large", LARGE_FEATURES_SQL)
def priority_rank_large(spark, sf_dir):
    """The flagship features on the large panel: one row per (customer, month)."""
    return canonical(FT.add_features(large_panel(spark, sf_dir), LARGE_SPEC, materialize=True))


@query("preprocess_manifest", f"""WITH {PANEL_CTE}
SELECT count(*) AS row_count, count(DISTINCT entity) AS entity_count, min(period) AS period_min, max(period) AS period_max,
       'lineitem.parquet;orders.parquet;customer.parquet' AS source_refs FROM panel""")
def preprocess_manifest(spark, sf_dir):
    """What the preprocessing run records of its panel."""
    from kestrel.sources.ingest import run_manifest_row
    return canonical(run_manifest_row(small_panel(spark, sf_dir), "entity", "period", ["lineitem.parquet", "orders.parquet", "customer.parquet"]))
