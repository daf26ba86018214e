"""Validation queries over the scored small panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import spec as S
from kestrel.operators import panel as P
from kestrel.operators import validate as V
from kestrel.plans.catalog import query
from kestrel.plans.output import canonical, r
from kestrel.plans.q_clean import SOURCES, clean_sql, cleaned
from kestrel.plans.q_panel import features_panel
from kestrel.plans.sqltext import feature_ctes
from kestrel.plans.testdata import PANEL_CTE, SMALL_SPEC

SPEC = SMALL_SPEC
FEAT = f"WITH {PANEL_CTE},\n{feature_ctes(SPEC)}"


def _domain_sql(m) -> str:
    conds = []
    if m.low is not None:
        conds.append(f"{m.name} {'>' if m.low_strict else '>='} {m.low}")
    if m.high is not None:
        conds.append(f"{m.name} <= {m.high}")
    return f"count_if({m.name} IS NOT NULL AND NOT ({' AND '.join(conds) or 'TRUE'}))"


def _st(cond: str, warn: bool = False) -> str:
    return f"CASE WHEN {cond} THEN 'PASS' ELSE '{'WARN' if warn else 'FAIL'}' END"


_k = len(SPEC.risk_metrics)
_COUNTERS = f"""cnt AS (SELECT
  count_if(entity IS NULL) + count_if(period IS NULL) AS missing_keys,
  count_if(entity IS NULL) + count_if(entity_name IS NULL) + count_if(group_name IS NULL) AS missing_dims,
  count(DISTINCT entity) AS n_entities, min(period) AS pmin, max(period) AS pmax,
  max(CASE WHEN score IS NOT NULL THEN period END) AS latest_scored,
  count_if(n_score_components < {_k} AND score IS NOT NULL) AS iws,
  count_if(n_score_components = {_k} AND score IS NULL) AS cws,
  count_if(score IS NOT NULL AND priority_rank IS NULL) AS swr,
  count_if(score IS NULL AND priority_rank IS NOT NULL) AS rws,
  {', '.join(f"{_domain_sql(m)} AS inv_{m.name}, count_if({m.name} = 0) AS z_{m.name}" for m in SPEC.metrics)},
  (SELECT count(*) - count(DISTINCT (entity, period)) FROM feat) AS dup_keys,
  (SELECT count(*) FROM feat) - (SELECT count(*) FROM (SELECT DISTINCT * FROM feat) x) AS exact_dups
FROM feat)"""

_ROWS = [
    (1, "required_columns_present", "'PASS'", "'all present'", "Every dimension, key and metric column exists."),
    (2, "unique_entity_period_key", _st("dup_keys = 0"), "CAST(dup_keys AS VARCHAR)", "No duplicate (entity, period) rows."),
    (3, "no_exact_duplicate_rows", _st("exact_dups = 0"), "CAST(exact_dups AS VARCHAR)", "No exact duplicate rows."),
    (4, "no_missing_key_values", _st("missing_keys = 0"), "CAST(missing_keys AS VARCHAR)", "No missing entity or period."),
    (5, "no_missing_dimension_values", _st("missing_dims = 0"), "CAST(missing_dims AS VARCHAR)", "No missing dimension values."),
    (6, "expected_entity_count", _st(f"n_entities = {SPEC.expected_entities}", warn=True), "CAST(n_entities AS VARCHAR)",
     f"Expected {SPEC.expected_entities} entities in the panel."),
    (7, "period_range_available", "'PASS'", "CAST(pmin AS VARCHAR) || '-' || CAST(pmax AS VARCHAR)",
     "Record the available period range; metrics need not cover every period."),
    (8, "analysis_period_matches_scope", _st(f"pmin = {SPEC.period_start} AND pmax = {SPEC.period_end}"),
     "CAST(pmin AS VARCHAR) || '-' || CAST(pmax AS VARCHAR)",
     f"Panel should span the analysis scope {SPEC.period_start}-{SPEC.period_end}."),
]
for _i, _m in enumerate(SPEC.metrics):
    _ROWS.append((9 + _i, f"{_m.name}_domain_range", _st(f"inv_{_m.name} = 0"), f"CAST(inv_{_m.name} AS VARCHAR)",
                  "Non-null values lie inside the declared domain."))
_n = 9 + len(SPEC.metrics)
_ROWS += [
    (_n, "no_zero_placeholders_remaining", _st(" + ".join(f"z_{m.name}" for m in SPEC.metrics) + " = 0"),
     " || '; ' || ".join(f"'{m.name}=' || CAST(z_{m.name} AS VARCHAR)" for m in SPEC.metrics),
     "Zero placeholders were converted to missing values."),
    (_n + 1, "latest_scored_period_exists", _st("latest_scored IS NOT NULL"), "CAST(latest_scored AS VARCHAR)",
     "At least one period has a complete score."),
    (_n + 2, "score_only_when_components_complete", _st("iws = 0 AND cws = 0"),
     "'incomplete_with_score=' || CAST(iws AS VARCHAR) || '; complete_without_score=' || CAST(cws AS VARCHAR)",
     f"The score exists only when all {_k} risk components exist."),
    (_n + 3, "priority_rank_matches_score_availability", _st("swr = 0 AND rws = 0"),
     "'score_without_rank=' || CAST(swr AS VARCHAR) || '; rank_without_score=' || CAST(rws AS VARCHAR)",
     "A rank exists exactly when a score exists."),
]
VALIDATION_SQL = FEAT + ",\n" + _COUNTERS + "\n" + "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS BIGINT) AS check_order, '{n}' AS check_name, {st} AS status, {v} AS value, '{e}' AS expectation FROM cnt"
    for i, n, st, v, e in _ROWS)


@query("validation_checks", VALIDATION_SQL)
def validation_checks(spark, sf_dir):
    """17 named PASS/WARN/FAIL checks in two aggregate passes over the scored panel."""
    return canonical(V.validation_checks(features_panel(spark, sf_dir), SPEC))


# The scored panel with dirt derived from its own rows, so that checks fail and warn.
_DIRT = {"m_disc": "CASE WHEN entity % 5 = 0 THEN 0.0 ELSE m_disc END", "m_tax": "CASE WHEN entity % 7 = 0 THEN -1.0 ELSE m_tax END",
         "score": "CASE WHEN entity % 6 = 0 THEN NULL ELSE score END", "entity_name": "CASE WHEN entity % 9 = 0 THEN NULL ELSE entity_name END"}
_DIRTY_SQL = f"""dirty0 AS (SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in _DIRT.items())}) FROM feat WHERE entity <> 3),
dirty AS (SELECT * FROM dirty0 UNION ALL SELECT * FROM dirty0 WHERE entity % 8 = 1)"""


@query("validation_checks_dirty", FEAT + ",\n" + _DIRTY_SQL + ",\n" + _COUNTERS.replace("FROM feat", "FROM dirty") + "\n" + "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS BIGINT) AS check_order, '{n}' AS check_name, {st} AS status, {v} AS value, '{e}' AS expectation FROM cnt"
    for i, n, st, v, e in _ROWS))
def validation_checks_dirty(spark, sf_dir):
    """The same checks over a panel with repeated rows, zeros, values outside their domain, missing
    scores and names, and a missing entity."""
    feat = features_panel(spark, sf_dir)
    dirty = feat.where("entity <> 3").withColumns({c: F.expr(e) for c, e in _DIRT.items()})
    return canonical(V.validation_checks(dirty.unionByName(dirty.where("entity % 8 = 1")), SPEC))


@query("metric_coverage", f"""{FEAT}
SELECT period, {', '.join(f'count({m}) AS {m}' for m in SPEC.metric_names)} FROM feat GROUP BY period""")
def metric_coverage(spark, sf_dir):
    return V.coverage_by_period(features_panel(spark, sf_dir), SPEC)


@query("quality_kpis", f"""WITH checks AS ({VALIDATION_SQL.replace('WITH ', 'WITH ', 1)})
SELECT count_if(status = 'PASS') AS checks_passed, count(*) AS checks_total,
       count_if(status = 'FAIL') AS checks_failed FROM checks""")
def quality_kpis(spark, sf_dir):
    """Dashboard quality summary: passed / total / failed checks."""
    checks = V.validation_checks(features_panel(spark, sf_dir), SPEC)
    return checks.agg(F.count_if(F.col("status") == S.PASS).alias("checks_passed"),
                      F.count(F.lit(1)).alias("checks_total"),
                      F.count_if(F.col("status") == S.FAIL).alias("checks_failed"))


@query("imputation_kpis", "WITH " + ",\n".join(clean_sql(n) for n in SOURCES) + "\nSELECT " + " + ".join(
    f"(SELECT count_if({SOURCES[n][0].metric}_was_imputed) FROM {n}_clean)" for n in SOURCES)
    + f" AS total_imputed, CAST({len(SOURCES)} AS BIGINT) AS sources")
def imputation_kpis(spark, sf_dir):
    """Total imputed values and sources profiled (from the quality profiles)."""
    profiles = [cleaned(spark, sf_dir, n)[1] for n in SOURCES]
    out = profiles[0]
    for p in profiles[1:]:
        out = out.unionByName(p)
    return out.agg(F.sum("imputed_values").alias("total_imputed"), F.count(F.lit(1)).alias("sources"))


@query("latest_scored_period", f"""{FEAT}
SELECT max(CASE WHEN score IS NOT NULL THEN period END) AS period FROM feat""")
def latest_scored_period(spark, sf_dir):
    return P.latest_scored_period(features_panel(spark, sf_dir), SPEC)


@query("cross_section", f"""{FEAT}
SELECT entity, period, {r('score')} AS score FROM feat
WHERE period = (SELECT max(CASE WHEN score IS NOT NULL THEN period END) FROM feat)""")
def cross_section(spark, sf_dir):
    snap = P.cross_section(features_panel(spark, sf_dir), SPEC, latest=True)
    return canonical(snap.select("entity", "period", "score"))


@query("complete_cases", f"""{FEAT}
SELECT count(*) AS rows_total, count_if(m_ret IS NOT NULL AND m_disc IS NOT NULL AND m_qty IS NOT NULL AND m_tax IS NOT NULL
       AND m_ret_yoy_change IS NOT NULL) AS rows_complete FROM feat""")
def complete_cases(spark, sf_dir):
    """Rows with every clustering feature (and a prior-period change) present."""
    feat = features_panel(spark, sf_dir)
    kept = P.complete_cases(feat, ["m_ret", "m_disc", "m_qty", "m_tax", "m_ret_yoy_change"])
    return V.combine_single_rows([feat.agg(F.count(F.lit(1)).alias("rows_total")),
                                  kept.agg(F.count(F.lit(1)).alias("rows_complete"))])
