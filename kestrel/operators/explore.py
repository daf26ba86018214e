"""Exploration: describe, correlation, yearly means, entity change, group comparison,
top/bottom lists, change extremes, histograms. All single-pass aggregates; top-k lists
use ``orderBy().limit()`` which plans as a per-partition TakeOrdered (no global sort)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.numeric import round_half_even

from kestrel import spec as S
from kestrel.functions.labels import entity_type
from kestrel.operators.clean import combine_single_rows
from kestrel.operators.joins import join_small
from kestrel.operators.quantiles import quantile_row
from kestrel.spec import PanelSpec

QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, cols: list[str], labels: dict | None = None) -> DataFrame:
    """count, mean, std (ddof=1), min, exact linear quartiles, max per column, long layout.

    ``DataFrame.summary()`` is not used: its percentiles are approximate and it returns
    strings. Quartiles come from :func:`exact_quantiles` (no single-task value map).
    """
    labels = labels or {}
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__std"), F.min(c).cast("double").alias(f"{c}__min"),
                 F.max(c).cast("double").alias(f"{c}__max")]
    quart = quantile_row(df, cols, list(QUARTILES), [f"{c}__{q}" for c in cols for q in ("p25", "p50", "p75")])
    wide = combine_single_rows([df.agg(*aggs), quart])
    rows = F.array(*[F.struct(
        F.lit(c).alias("indicator"), F.lit(labels.get(c, c)).alias("label"),
        F.col(f"{c}__count").alias("count"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
        F.col(f"{c}__min").alias("min"), F.col(f"{c}__p25").alias("p25"), F.col(f"{c}__p50").alias("p50"),
        F.col(f"{c}__p75").alias("p75"), F.col(f"{c}__max").alias("max")) for c in cols])
    return wide.select(F.inline(rows))


def _pair_corr(a: str, b: str) -> Column:
    """Pearson r over rows where both are present; constant column → null (no exception)."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    xa, xb = F.when(both, F.col(a)), F.when(both, F.col(b))
    return F.try_divide(F.covar_pop(xa, xb), F.stddev_pop(xa) * F.stddev_pop(xb))


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Upper-triangle (a, b, r) rows from one aggregate."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[_pair_corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("indicator_a"), F.lit(b).alias("indicator_b"),
                              F.col(f"{a}__{b}").alias("pearson_r")) for a, b in pairs])
    return wide.select(F.inline(rows))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Square matrix: one row per indicator, one column per indicator (diagonal 1 unless constant)."""
    keys = {(a, b) for a in cols for b in cols if cols.index(a) <= cols.index(b)}
    wide = df.agg(*[_pair_corr(a, b).alias(f"{a}__{b}") for a, b in sorted(keys)])
    def cell(a, b):
        x, y = (a, b) if cols.index(a) <= cols.index(b) else (b, a)
        v = F.col(f"{x}__{y}")
        # r(a,a) is 1 by definition when the variance is positive
        return F.when(v.isNotNull(), F.lit(1.0)) if a == b else v
    rows = F.array(*[F.struct(F.lit(a).alias("indicator"), *[cell(a, b).alias(b) for b in cols]) for a in cols])
    return wide.select(F.inline(rows))


def high_correlation_pairs(df: DataFrame, cols: list[str], threshold: float = 0.8) -> DataFrame:
    pairs = correlation_pairs(df, cols)
    return (pairs.where(F.col("pearson_r").isNotNull() & (F.abs("pearson_r") >= threshold))
            .withColumn("pearson_r", round_half_even("pearson_r", 4)))


def yearly_trend(panel: DataFrame, spec: PanelSpec, digits: int = 4) -> DataFrame:
    """Mean of each metric per period; scored-entity count is null (not 0) when none."""
    return panel.groupBy(spec.period).agg(
        *[round_half_even(F.avg(m), digits).alias(m) for m in spec.metric_names],
        F.nullif(F.count(spec.score_col), F.lit(0)).alias("entities_with_score"))


def entity_change(panel: DataFrame, spec: PanelSpec, metric: str | None = None, digits: int = 4) -> DataFrame:
    """Per entity: first and last non-null value of ``metric`` by period and the difference."""
    m = metric or spec.trend
    known = F.when(F.col(m).isNotNull(), F.col(spec.period))
    name = [F.col(spec.entity_name)] if spec.entity_name else []
    first = F.min_by(F.struct(F.col(spec.period).alias("p"), F.col(m).alias("v")), known)
    last = F.max_by(F.struct(F.col(spec.period).alias("p"), F.col(m).alias("v"), *[n.alias("name") for n in name]), known)
    g = panel.groupBy(spec.entity).agg(first.alias("f"), last.alias("l")).where(F.col("f").isNotNull())
    cols = [F.col(spec.entity)]
    if spec.entity_name:
        cols.append(F.col("l.name").alias(spec.entity_name))
    return g.select(*cols, F.col("f.p").alias("period_first"), F.col("l.p").alias("period_last"),
                    round_half_even(F.col("f.v"), digits).alias("value_first"), round_half_even(F.col("l.v"), digits).alias("value_last"),
                    round_half_even(F.col("l.v") - F.col("f.v"), digits).alias("change"))


def group_comparison(frame: DataFrame, spec: PanelSpec, type_source: str, prefix: str = S.CITY_PREFIX,
                     digits: int = 4) -> DataFrame:
    """Means per administrative type (name prefix rule) plus group size."""
    typed = frame.withColumn("entity_type", entity_type(type_source, prefix))
    return typed.groupBy("entity_type").agg(
        *[round_half_even(F.avg(m), digits).alias(m) for m in spec.metric_names],
        F.count(F.lit(1)).alias("n_entities"))


def top_bottom(frame: DataFrame, spec: PanelSpec, n: int = 5, cols: list[str] | None = None) -> DataFrame:
    """n highest and n lowest scores (lists may overlap when rows < 2n), entity breaks ties."""
    cols = cols or [spec.entity, spec.score_col]
    scored = frame.where(F.col(spec.score_col).isNotNull()).select(*cols)
    top = scored.orderBy(F.col(spec.score_col).desc(), F.col(spec.entity)).limit(n)
    bottom = scored.orderBy(F.col(spec.score_col).asc(), F.col(spec.entity).desc()).limit(n)
    return (top.withColumn("group", F.lit(S.GROUP_MOST))
            .unionByName(bottom.withColumn("group", F.lit(S.GROUP_LEAST))))


# Direction labels of the change view.
CHANGE_UP = "Kemiskinan meningkat"
CHANGE_DOWN = "Kemiskinan menurun"


def change_extremes(changes: DataFrame, key: str, change: str = "change", limit: int = 10) -> DataFrame:
    """The limit//2 smallest and limit//2 largest changes, labelled (0 counts as down)."""
    h = limit // 2
    low = changes.orderBy(F.col(change).asc(), F.col(key)).limit(h)
    high = changes.orderBy(F.col(change).desc(), F.col(key).desc()).limit(h)
    both = low.unionByName(high)
    return both.withColumn("direction", F.when(F.col(change) > 0, CHANGE_UP).otherwise(CHANGE_DOWN))


def histogram(df: DataFrame, col: str, bins: int = 12) -> DataFrame:
    """``bins`` equal-width bins between min and max, empty ones included; the maximum lands in the
    last bin. Constant data spans a unit interval around its value. No values: no bins."""
    stats = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).where("lo is not null")
    flat = F.col("lo") == F.col("hi")
    stats = stats.select(F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("__lo"),
                         F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("__hi"), F.lit(1).alias("__one"))
    x = df.select(col).where(F.col(col).isNotNull()).withColumn("__one", F.lit(1))
    joined = join_small(x, stats, "__one", "inner", bound=1)
    bin_of = F.least(F.floor((F.col(col) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins) + 1, F.lit(bins))
    counted = joined.groupBy(bin_of.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = stats.select("__lo", "__hi", F.explode(F.sequence(F.lit(1), F.lit(bins)).cast("array<bigint>")).alias("bin"))
    width = F.col("__hi") - F.col("__lo")
    return every.join(counted, "bin", "left").select(
        "bin", F.coalesce("count", F.lit(0)).alias("count"),
        (F.col("__lo") + (F.col("bin") - 1) * width / bins).alias("lower"), (F.col("__lo") + F.col("bin") * width / bins).alias("upper"))
