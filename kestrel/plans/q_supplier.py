"""The full scrub path on a second panel: four per-(supplier, ship year) metric sources
are cleaned (dedup, zero-as-missing, interpolation), integrated with one union +
aggregate, joined to supplier names, restricted to the analysis period and given every
panel feature. One source is a count whose zeros are missing-value placeholders, so the
zero/interpolation steps do real work."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import clean as C
from kestrel.operators import features as FT
from kestrel.operators import joins as J
from kestrel.operators import panel as P
from kestrel.plans.catalog import query
from kestrel.plans.output import canonical
from kestrel.plans.sqltext import clean_ctes, feature_ctes, feature_select
from kestrel.plans.testdata import hundredths, table
from kestrel.spec import CONTEXT_ONLY, HIGH_IS_RISKY, LOW_IS_RISKY, MetricSpec, PanelSpec

SUP_METRICS = (
    MetricSpec("s_disc", "Average discount of returned lines", "percent", HIGH_IS_RISKY, low=0.0, high=100.0),
    MetricSpec("s_tax", "Average tax of open lines", "percent", HIGH_IS_RISKY, low=0.0, high=100.0),
    MetricSpec("s_qty", "Average quantity", "units", LOW_IS_RISKY, low=0.0, high=100.0),
    MetricSpec("s_bigret", "Large returned lines", "lines", CONTEXT_ONLY, low=0.0, low_strict=True),
)
SUP_SPEC = PanelSpec(entity="entity", period="period", metrics=SUP_METRICS, entity_name="entity_name",
                     dims=("entity", "entity_name"), trend_metric="s_disc", period_start=1995, period_end=2001)
START, END = SUP_SPEC.period_start, SUP_SPEC.period_end

# source name → (metric, its aggregate as SQL over the source's rows, row filter)
SOURCES = {
    "disc_returned": ("s_disc", "CAST(sum(CAST(round(l_discount*100) AS BIGINT)) AS DOUBLE) / count(*)",
                      "l_returnflag = 'R'"),
    "tax_open": ("s_tax", "CAST(sum(CAST(round(l_tax*100) AS BIGINT)) AS DOUBLE) / count(*)", "l_linestatus = 'O'"),
    "quantity_all": ("s_qty", "sum(l_quantity) / count(*)", "TRUE"),
    "big_returns": ("s_bigret", "CAST(count_if(l_quantity >= 48) AS DOUBLE)", "l_returnflag = 'R'"),
}


def supplier_sources(spark, sf_dir):
    """All four sources from ONE scan and one partial aggregate of the line items: each
    source's aggregate is evaluated over its own rows (``when(filter)`` inside the
    aggregate) and a source keeps only the (supplier, year) keys it has rows for."""
    li = table(spark, sf_dir, "lineitem").withColumn("period", F.year("l_shipdate").cast("bigint"))
    aggs = []
    for name, (metric, _, cond) in SOURCES.items():
        inside = F.expr(cond)
        # re-express the source aggregate on filtered inputs (nulls are ignored by sum/count)
        if metric == "s_qty":
            aggs += [F.sum(F.when(inside, F.col("l_quantity"))).alias(f"__s_{name}")]
        elif metric == "s_bigret":
            aggs += [F.count_if(inside & (F.col("l_quantity") >= 48)).cast("double").alias(f"__s_{name}")]
        else:
            src = "l_discount" if metric == "s_disc" else "l_tax"
            aggs += [F.sum(F.when(inside, hundredths(src))).alias(f"__s_{name}")]
        aggs += [F.count_if(inside).alias(f"__n_{name}")]
    wide = li.groupBy(F.col("l_suppkey").alias("entity"), "period").agg(*aggs)
    out = {}
    for name, (metric, _, _) in SOURCES.items():
        n, sm = F.col(f"__n_{name}"), F.col(f"__s_{name}")
        value = sm if metric == "s_bigret" else sm.cast("double") / n
        out[name] = wide.where(n > 0).select("entity", "period", value.alias(metric))
    return out


def supplier_panel(spark, sf_dir):
    frames, profiles = [], []
    for name, raw in supplier_sources(spark, sf_dir).items():
        metric = SOURCES[name][0]
        # one row per key: the ordinal has nothing to decide
        ds = C.DatasetSpec(name, metric=metric, entity="entity", period="period", order_col="period")
        cleaned, profile = C.clean_dataset(raw, ds)
        frames.append(cleaned)
        profiles.append(profile)
    panel = J.union_aggregate(frames, ["entity", "period"])
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("entity_name"))
    panel = panel.join(names, "entity", "left")
    return P.filter_period(panel, SUP_SPEC, START, END), profiles


_SQL_SOURCES = ",\n".join(
    clean_ctes(name, f"SELECT l_suppkey AS entity, CAST(year(l_shipdate) AS BIGINT) AS period, {sql} AS {metric} "
               f"FROM lineitem WHERE {cond} GROUP BY 1, 2", "entity", "period", None, metric)
    for name, (metric, sql, cond) in SOURCES.items())
_NAMES = list(SOURCES)
_JOIN = f"(SELECT entity, period, {SOURCES[_NAMES[0]][0]}, {SOURCES[_NAMES[0]][0]}_was_imputed FROM {_NAMES[0]}_clean) s0" + "".join(
    f"\n  FULL OUTER JOIN (SELECT entity, period, {SOURCES[n][0]}, {SOURCES[n][0]}_was_imputed FROM {n}_clean) s{i} "
    f"USING (entity, period)" for i, n in enumerate(_NAMES[1:], 1))
FLAGS = [f"{SOURCES[n][0]}_was_imputed" for n in _NAMES]
SUPPLIER_SQL = f"""WITH {_SQL_SOURCES},
joined AS (SELECT * FROM {_JOIN}),
panel2 AS (SELECT j.*, s.s_name AS entity_name FROM joined j LEFT JOIN supplier s ON j.entity = s.s_suppkey
           WHERE j.period BETWEEN {START} AND {END}),
{feature_ctes(SUP_SPEC, src="panel2", flags=FLAGS)}
SELECT {feature_select(SUP_SPEC, extra=['entity_name'])} FROM feat"""


@query("supplier_panel_features", SUPPLIER_SQL)
def supplier_panel_features(spark, sf_dir):
    """Scrub → integrate → period filter → features on the (supplier, ship year) panel."""
    panel, _ = supplier_panel(spark, sf_dir)
    feat = FT.add_features(panel, SUP_SPEC, materialize=True)
    cols = ["entity_name", "entity", "period"] + [c for c in feat.columns if c not in (
        "entity_name", "entity", "period") and not c.endswith("_was_imputed")]
    return canonical(feat.select(*cols))


@query("supplier_quality_profile", "WITH " + _SQL_SOURCES + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{n}' AS logical_name, '{SOURCES[n][0]}' AS metric,
  (SELECT count(*) FROM {n}_raw) AS rows_raw, (SELECT count(*) FROM {n}_clean) AS rows_clean,
  (SELECT count_if({SOURCES[n][0]}_orig = 0) FROM {n}_clean) AS invalid_zero_values,
  (SELECT count_if({SOURCES[n][0]}_was_imputed) FROM {n}_clean) AS imputed_values,
  (SELECT count_if({SOURCES[n][0]}_zeroed IS NULL) FROM {n}_clean) AS missing_metric_before_impute""" for n in _NAMES))
def supplier_quality_profile(spark, sf_dir):
    """Quality counters of the four supplier sources (before the period filter)."""
    _, profiles = supplier_panel(spark, sf_dir)
    out = profiles[0]
    for p in profiles[1:]:
        out = out.unionByName(p)
    return out.select("logical_name", "metric", "rows_raw", "rows_clean", "invalid_zero_values", "imputed_values",
                      "missing_metric_before_impute")
