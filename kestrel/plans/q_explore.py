"""Exploration queries over the scored small panel and its latest scored snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import explore as X
from kestrel.operators import panel as P
from kestrel.plans.catalog import query
from kestrel.plans.output import canonical, r
from kestrel.plans.q_panel import features_panel
from kestrel.plans.sqltext import feature_ctes
from kestrel.plans.testdata import METRICS, PANEL_CTE, SMALL_SPEC, TYPE_PREFIX, table

SPEC = SMALL_SPEC
FEAT = f"WITH {PANEL_CTE},\n{feature_ctes(SPEC)}"
SNAP = f"""{FEAT},
snap AS (SELECT * FROM feat WHERE period = (SELECT max(CASE WHEN score IS NOT NULL THEN period END) FROM feat))"""
LABELS = {m.name: m.label for m in METRICS}
DESCRIBE_COLS = [*SPEC.metric_names, SPEC.score_col]


def snapshot(spark, sf_dir):
    return P.cross_section(features_panel(spark, sf_dir), SPEC, latest=True)


@query("descriptive_stats", SNAP + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS indicator, '{LABELS.get(c, c)}' AS label, count({c}) AS count, {r(f'avg({c})')} AS mean,
  {r(f'stddev_samp({c})')} AS std, {r(f'min({c})')} AS min, {r(f'quantile_cont({c}, 0.25)')} AS p25,
  {r(f'quantile_cont({c}, 0.5)')} AS p50, {r(f'quantile_cont({c}, 0.75)')} AS p75, {r(f'max({c})')} AS max FROM snap"""
    for c in DESCRIBE_COLS))
def descriptive_stats(spark, sf_dir):
    return canonical(X.describe(snapshot(spark, sf_dir), DESCRIBE_COLS, LABELS))


def _corr_sql(a, b):
    cond = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return (f"covar_pop({a}, {b}) FILTER (WHERE {cond}) / NULLIF(stddev_pop({a}) FILTER (WHERE {cond}) * "
            f"stddev_pop({b}) FILTER (WHERE {cond}), 0)")


_M = SPEC.metric_names


@query("correlation_matrix", SNAP + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS indicator, " + ", ".join(
        (f"{r(f'CASE WHEN stddev_pop({a}) > 0 THEN 1.0e0 END')} AS {b}" if a == b else f"{r(_corr_sql(a, b))} AS {b}")
        for b in _M) + " FROM snap" for a in _M))
def correlation_matrix(spark, sf_dir):
    """Pearson matrix of the latest snapshot (pairwise complete, constant → null)."""
    return canonical(X.correlation_matrix(snapshot(spark, sf_dir), _M))


@query("high_correlation_pairs", f"""{FEAT},
pairs AS ({' UNION ALL '.join(f"SELECT '{a}' AS indicator_a, '{b}' AS indicator_b, {_corr_sql(a, b)} AS r FROM feat" for i, a in enumerate(_M) for b in _M[i + 1:])})
SELECT indicator_a, indicator_b, {r('r')} AS pearson_r FROM pairs WHERE r IS NOT NULL AND abs(r) >= 0.05""")
def high_correlation_pairs(spark, sf_dir):
    """Related metric pairs over all panel rows (|r| >= 0.05, which some pairs reach and others don't)."""
    return X.high_correlation_pairs(features_panel(spark, sf_dir), _M, 0.05)


@query("yearly_trend", f"""{FEAT}
SELECT period, {', '.join(f"{r(f'avg({m})')} AS {m}" for m in _M)},
       NULLIF(count(score), 0) AS entities_with_score FROM feat GROUP BY period""")
def yearly_trend(spark, sf_dir):
    return canonical(X.yearly_trend(features_panel(spark, sf_dir), SPEC))


@query("entity_change", f"""{FEAT},
v AS (SELECT * FROM feat WHERE m_ret IS NOT NULL),
ends AS (SELECT entity, min(period) AS p0, max(period) AS p1 FROM v GROUP BY entity)
SELECT e.entity, l.entity_name, e.p0 AS period_first, e.p1 AS period_last,
       {r('f.m_ret')} AS value_first, {r('l.m_ret')} AS value_last, {r('l.m_ret - f.m_ret')} AS change
FROM ends e JOIN v f ON f.entity = e.entity AND f.period = e.p0 JOIN v l ON l.entity = e.entity AND l.period = e.p1""")
def entity_change(spark, sf_dir):
    """First-to-last change of the trend metric per entity (all-null entities omitted)."""
    return canonical(X.entity_change(features_panel(spark, sf_dir), SPEC)).orderBy("change", "entity")


@query("group_comparison", f"""{SNAP}
SELECT CASE WHEN starts_with(group_name, '{TYPE_PREFIX}') THEN 'kota' ELSE 'kabupaten' END AS entity_type,
       {', '.join(f"{r(f'avg({m})')} AS {m}" for m in _M)}, count(*) AS n_entities FROM snap GROUP BY 1""")
def group_comparison(spark, sf_dir):
    return canonical(X.group_comparison(snapshot(spark, sf_dir), SPEC, "group_name", TYPE_PREFIX))


@query("top_bottom", f"""{SNAP},
s AS (SELECT entity, entity_name, score, m_ret, m_qty FROM snap WHERE score IS NOT NULL)
SELECT entity, entity_name, {r('score')} AS score, {r('m_ret')} AS m_ret, {r('m_qty')} AS m_qty, 'paling_rentan' AS "group"
FROM (SELECT * FROM s ORDER BY score DESC, entity LIMIT 5)
UNION ALL
SELECT entity, entity_name, {r('score')}, {r('m_ret')}, {r('m_qty')}, 'paling_tidak_rentan'
FROM (SELECT * FROM s ORDER BY score ASC, entity DESC LIMIT 5)""")
def top_bottom(spark, sf_dir):
    """Five most and five least vulnerable entities of the latest snapshot."""
    cols = ["entity", "entity_name", "score", "m_ret", "m_qty"]
    return canonical(X.top_bottom(snapshot(spark, sf_dir), SPEC, 5, cols))


@query("change_extremes", f"""{FEAT},
v AS (SELECT * FROM feat WHERE m_ret IS NOT NULL),
ends AS (SELECT entity, min(period) AS p0, max(period) AS p1 FROM v GROUP BY entity),
ch AS (SELECT e.entity, {r('l.m_ret - f.m_ret')} AS change
       FROM ends e JOIN v f ON f.entity = e.entity AND f.period = e.p0 JOIN v l ON l.entity = e.entity AND l.period = e.p1)
SELECT entity, change, CASE WHEN change > 0 THEN '{X.CHANGE_UP}' ELSE '{X.CHANGE_DOWN}' END AS direction FROM (
  SELECT * FROM (SELECT * FROM ch ORDER BY change ASC, entity LIMIT 5)
  UNION ALL SELECT * FROM (SELECT * FROM ch ORDER BY change DESC, entity DESC LIMIT 5))""")
def change_extremes(spark, sf_dir):
    ch = X.entity_change(features_panel(spark, sf_dir), SPEC).select("entity", "change")
    return canonical(X.change_extremes(ch, "entity", "change", 10))


@query("histogram", f"""WITH b AS (SELECT CAST(min(value) AS DOUBLE) AS lo, CAST(max(value) AS DOUBLE) AS hi FROM events),
e AS (SELECT i AS bin, lo + (i - 1) * (hi - lo) / 12 AS a, lo + i * (hi - lo) / 12 AS z, lo, hi FROM b, range(1, 13) t(i))
SELECT bin, (SELECT count(*) FROM events, b WHERE value IS NOT NULL
             AND least(CAST(floor((value - b.lo) / (b.hi - b.lo) * 12) AS BIGINT) + 1, 12) = e.bin) AS count,
       {r('a')} AS lower, {r('z')} AS upper FROM e""")
def histogram(spark, sf_dir):
    """12 equal-width bins over every event value (maximum in the last bin)."""
    return canonical(X.histogram(table(spark, sf_dir, "events"), "value", 12))


@query("panel_kpis", f"""{FEAT}
SELECT count(*) AS rows, count(DISTINCT entity) AS n_entities, min(period) AS period_min, max(period) AS period_max,
       count(score) AS scored_rows FROM feat""")
def panel_kpis(spark, sf_dir):
    feat = features_panel(spark, sf_dir)
    return feat.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("entity").alias("n_entities"),
                    F.min("period").alias("period_min"), F.max("period").alias("period_max"),
                    F.count("score").alias("scored_rows"))
