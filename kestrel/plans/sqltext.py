"""SQL text for the independent oracle (DuckDB dialect, also valid for most ANSI engines).

These strings are written from the operator semantics, not generated from Spark plans;
they exist so every registered query has a second, independent implementation.
"""

from __future__ import annotations

from kestrel import spec as S
from kestrel.plans.output import r
from kestrel.spec import PanelSpec


def case_trend(delta: str) -> str:
    t = S.TREND_DELTA_THRESHOLD
    return (f"CASE WHEN {delta} > {t} THEN '{S.TREND_UP}' WHEN {delta} < -{t} THEN '{S.TREND_DOWN}' "
            f"WHEN {delta} IS NOT NULL THEN '{S.TREND_FLAT}' ELSE '{S.TREND_NO_BASE}' END")


def case_slope(slope: str) -> str:
    t = S.SLOPE_TOLERANCE
    return (f"CASE WHEN {slope} IS NULL THEN '{S.SLOPE_UNKNOWN}' WHEN {slope} > {t} THEN '{S.SLOPE_WORSE}' "
            f"WHEN {slope} < -{t} THEN '{S.SLOPE_BETTER}' ELSE '{S.SLOPE_FLAT}' END")


def case_bucket(pct: str) -> str:
    arms = " ".join(f"WHEN {pct} >= 0 AND {pct} <= {edge} THEN '{label}'" for edge, label in S.PRIORITY_BUCKETS)
    return f"CASE {arms} END"


def case_priority_action(level: str, trend: str) -> str:
    arms = " ".join(f"WHEN {level}='{lv}' AND {trend}='{tr}' THEN '{act}'"
                    for (lv, tr), act in S.PRIORITY_ACTION.items())
    return f"COALESCE(CASE {arms} END, '{S.PRIORITY_DEFAULT}')"


def zscore(m: str, part: str = "period") -> str:
    sd = f"stddev_pop({m}) OVER (PARTITION BY {part})"
    mu = f"avg({m}) OVER (PARTITION BY {part})"
    return (f"CASE WHEN {m} IS NULL THEN NULL WHEN {sd} IS NULL OR {sd} = 0 THEN 0.0e0 "
            f"ELSE ({m} - {mu}) / {sd} END")


def clean_ctes(name: str, raw_sql: str, e: str, p: str, i: str | None, m: str) -> str:
    """Scrub chain as CTEs: raw → exact dedup → keep-last per (e, p) → zero-null →
    interior interpolation by position; the last CTE is ``{name}_clean``."""
    w = f"PARTITION BY {e} ORDER BY {p}"
    order = f"{i} IS NULL DESC, {i} DESC, {m} DESC NULLS LAST" if i else "1"  # without an id keys are unique
    idc = f"{i}, " if i else ""
    return f"""{name}_raw AS ({raw_sql}),
{name}_dist AS (SELECT DISTINCT * FROM {name}_raw WHERE {e} IS NOT NULL AND {p} IS NOT NULL),
{name}_last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {e}, {p}
     ORDER BY {order}) AS rn FROM {name}_dist) t WHERE rn = 1),
{name}_z AS (SELECT {e}, {p}, {idc}{m} AS {m}_orig, NULLIF({m}, 0) AS v,
     row_number() OVER ({w}) AS pos FROM {name}_last),
{name}_nb AS (SELECT *,
     last_value(v IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pv,
     last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pi,
     first_value(v IGNORE NULLS) OVER ({w} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nv,
     first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER ({w} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ni
   FROM {name}_z),
{name}_clean AS (SELECT CAST({e} AS BIGINT) AS {e}, CAST({p} AS BIGINT) AS {p}, {idc}{m}_orig, v AS {m}_zeroed,
     CASE WHEN v IS NOT NULL THEN v WHEN pv IS NOT NULL AND nv IS NOT NULL
          THEN pv + (nv - pv) * (pos - pi) / (ni - pi) END AS {m},
     (v IS NULL AND pv IS NOT NULL AND nv IS NOT NULL) AS {m}_was_imputed
   FROM {name}_nb)"""


def feature_ctes(spec: PanelSpec, src: str = "panel", n_roll: int = 3, flags: list[str] | None = None) -> str:
    """CTEs chg → zs → feat; ``feat`` carries every feature column."""
    e, p = spec.entity, spec.period
    w = f"(PARTITION BY {e} ORDER BY {p})"
    chg = []
    for m in spec.metric_names:
        prev = f"lag({m}) OVER {w}"
        chg.append(f"{m} - {prev} AS {m}_yoy_change")
        chg.append(f"({m} - {prev}) / NULLIF({prev}, 0) * 100 AS {m}_yoy_pct_change")
    t = spec.trend
    chg.append(f"avg({t}) OVER (PARTITION BY {e} ORDER BY {p} ROWS BETWEEN {n_roll - 1} PRECEDING AND CURRENT ROW) "
               f"AS {t}_rolling_{n_roll}")
    zs = []
    for m in spec.risk_metrics:
        z = zscore(m.name, p)
        zs.append(f"{'-' if m.risk == S.LOW_IS_RISKY else ''}({z}) AS {m.name}_risk_z")
    zcols = [f"{m.name}_risk_z" for m in spec.risk_metrics]
    n_comp = " + ".join(f"CASE WHEN {z} IS NOT NULL THEN 1 ELSE 0 END" for z in zcols)
    total = " + ".join(zcols)
    n_avail = " + ".join(f"CASE WHEN {m} IS NOT NULL THEN 1 ELSE 0 END" for m in spec.metric_names)
    n_imp = " + ".join(f"CASE WHEN {f} THEN 1 ELSE 0 END" for f in flags) if flags else "0"
    return f"""chg AS (SELECT *, {', '.join(chg)} FROM {src}),
zs AS (SELECT *, {case_trend(f'{t}_yoy_change')} AS trend_direction, {', '.join(zs)} FROM chg),
sc AS (SELECT *, CAST({n_comp} AS BIGINT) AS n_score_components,
              {r(f'({total}) / {float(len(zcols))}', spec.score_digits)} AS {spec.score_col},
              CAST({n_imp} AS BIGINT) AS n_imputed, CAST({n_avail} AS BIGINT) AS n_available FROM zs),
feat AS (SELECT *,
   CASE WHEN {spec.score_col} IS NOT NULL THEN dense_rank() OVER (PARTITION BY {p} ORDER BY {spec.score_col} DESC NULLS LAST) END AS priority_rank,
   {case_bucket(f"CASE WHEN {spec.score_col} IS NOT NULL THEN rank() OVER (PARTITION BY {p} ORDER BY {spec.score_col} DESC NULLS LAST) / count({spec.score_col}) OVER (PARTITION BY {p}) END")} AS priority_bucket
 FROM sc)"""


def feature_select(spec: PanelSpec, extra: list[str] | None = None, n_roll: int = 3) -> str:
    """Final projection of ``feat`` with canonical rounding."""
    cols = list(extra or [])
    cols += [spec.entity, spec.period]
    for m in spec.metric_names:
        cols.append(f"{r(m)} AS {m}")
    for m in spec.metric_names:
        cols.append(f"{r(m + '_yoy_change')} AS {m}_yoy_change")
        cols.append(f"{r(m + '_yoy_pct_change')} AS {m}_yoy_pct_change")
    cols.append(f"{r(spec.trend + f'_rolling_{n_roll}')} AS {spec.trend}_rolling_{n_roll}")
    cols.append("trend_direction")
    for m in spec.risk_metrics:
        cols.append(f"{r(m.name + '_risk_z')} AS {m.name}_risk_z")
    cols += ["n_score_components", f"{r(spec.score_col)} AS {spec.score_col}",
             "CAST(priority_rank AS BIGINT) AS priority_rank", "priority_bucket", "n_imputed", "n_available"]
    return ", ".join(cols)
