"""Modelling-stage relational operators: trend slope, model frame, tertile levels, priority
actions and matrix, cluster relabelling and profiles, ANOVA / eta squared, effect sizes,
adjusted Rand index, expectation checks.

Every statistic is an aggregate (or a two-level aggregate) over Spark rows; per-cluster
tables have one row per cluster and are joined back by size (the planner broadcasts them while
they are small). Member lists are relations of their own, one row per (group, member).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.numeric import round_half_even

from kestrel import spec as S
from kestrel.functions.distributions import anova_p, welch_p
from kestrel.functions.labels import archetype, entity_type, priority_action, slope_label, tier_name
from kestrel.operators.joins import join_small
from kestrel.spec import PanelSpec

# ------------------------------------------------------------------ trend & frame
def with_target_period(panel: DataFrame, spec: PanelSpec, period: int | None) -> DataFrame:
    """Attach the model period as column ``__t``: a literal, or the latest scored period
    resolved inside the plan (one-row aggregate, bounded broadcast) so nothing is collected."""
    if period is not None:
        return panel.withColumn("__t", F.lit(int(period)).cast("bigint"))
    latest = panel.agg(F.max(F.when(F.col(spec.score_col).isNotNull(), F.col(spec.period))).alias("__t"))
    return join_small(panel.withColumn("__one", F.lit(1)), latest.withColumn("__one", F.lit(1)),
                      "__one", "inner", bound=1).drop("__one")


def trend_slope(panel: DataFrame, spec: PanelSpec, period: int | None = None, window: int = S.SLOPE_WINDOW,
                metric: str | None = None, min_points: int = 3, digits: int = 4) -> DataFrame:
    """OLS slope of ``metric`` on the calendar period over (period-window, period], >= min_points
    values; ``period=None`` means the latest scored period."""
    m = metric or spec.trend
    p = with_target_period(panel, spec, period)
    span = p.where(F.col(spec.period).between(F.col("__t") - window + 1, F.col("__t")))
    slope = F.regr_slope(F.col(m), F.col(spec.period).cast("double"))
    return span.groupBy(spec.entity).agg(
        F.when(F.count(m) >= min_points, round_half_even(slope, digits)).alias("trend_slope"))


def model_frame(panel: DataFrame, spec: PanelSpec, period: int | None, features: list[str],
                type_source: str, type_prefix: str = S.CITY_PREFIX, window: int = S.SLOPE_WINDOW) -> DataFrame:
    """Snapshot + complete cases + trend slope and label + administrative type."""
    p = with_target_period(panel, spec, period)
    snap = p.where(F.col(spec.period) == F.col("__t")).drop("__t").dropna(subset=list(features))
    slopes = trend_slope(panel, spec, period, window)
    out = snap.join(slopes, spec.entity, "left")
    return out.withColumns({
        "trend_label": slope_label("trend_slope"),
        "entity_type": entity_type(type_source, type_prefix),
    })


# ------------------------------------------------------------------ tertiles & priority
def tertile_edges(frame: DataFrame, col: str, probs=(1 / 3, 2 / 3)) -> DataFrame:
    """One row: min, the two exact linear quantiles, max."""
    from kestrel.operators.clean import combine_single_rows
    from kestrel.operators.quantiles import quantile_row
    ends = frame.agg(F.min(col).cast("double").alias("__e0"), F.max(col).cast("double").alias("__e3"))
    return combine_single_rows([ends, quantile_row(frame, col, list(probs), ["__e1", "__e2"])])


def add_tertile_level(frame: DataFrame, col: str, name: str = "vulnerability_level") -> DataFrame:
    """Quantile cut into three right-closed bins (low / middle / high); duplicate edges raise."""
    edges = tertile_edges(frame, col).withColumn("__one", F.lit(1))
    joined = join_small(frame.withColumn("__one", F.lit(1)), edges, "__one", "left", bound=1)
    e0, e1, e2 = F.col("__e0"), F.col("__e1"), F.col("__e2")
    dup = (e0 == e1) | (e1 == e2) | (e2 == F.col("__e3"))
    v = F.col(col)
    lo, mid, hi = S.LEVEL_LABELS
    level = (F.when(v.isNull(), F.lit(None).cast("string"))
             .when(dup, F.raise_error(F.lit("bin edges must be unique for a quantile cut")).cast("string"))
             .when(v <= e1, lo).when(v <= e2, mid).otherwise(hi))
    return joined.withColumn(name, level).drop("__one", "__e0", "__e1", "__e2", "__e3")


def add_priority_action(frame: DataFrame, level: str = "vulnerability_level", trend: str = "trend_label",
                        name: str = "priority_action") -> DataFrame:
    return frame.withColumn(name, priority_action(level, trend))


def priority_matrix(frame: DataFrame, level: str = "vulnerability_level", trend: str = "trend_label",
                    cluster: str = "cluster_id") -> DataFrame:
    """Level x trend cells present in the data: action, size, modal cluster (smallest on tie).
    The cells' members are :func:`group_members`."""
    cells = frame.groupBy(level, trend).agg(F.count(F.lit(1)).alias("n_entities"), F.mode(cluster, True).alias("dominant_cluster_id"))
    order_level = F.array_position(F.array(*[F.lit(x) for x in S.LEVEL_ORDER]), F.col(level))
    order_trend = F.array_position(F.array(*[F.lit(x) for x in S.TREND_ORDER]), F.col(trend))
    return cells.withColumns({
        "priority_action": priority_action(level, trend),
        "cell_order": (order_level * 10 + order_trend).cast("bigint"),
    })


def group_members(frame: DataFrame, group_cols: list[str], name_col: str) -> DataFrame:
    """Long form of a member list: one row per (group, member), for any group size."""
    return frame.select(*group_cols, F.col(name_col).alias("member"))


# ------------------------------------------------------------------ clusters
def relabel_by_score(frame: DataFrame, raw: str, score: str, name: str = "cluster_id") -> DataFrame:
    """Rename raw cluster labels so 0 is the highest mean score (raw label breaks ties)."""
    means = frame.groupBy(raw).agg(F.avg(score).alias("__mean"))
    # The k (mean, label) pairs are sorted inside one array; a label's position is its new id.
    key = F.struct(F.coalesce(-F.col("__mean"), F.lit(float("inf"))).alias("m"), F.col(raw).alias("r"))
    ordered = means.agg(F.array_sort(F.collect_list(key)).alias("__order")).withColumn("__one", F.lit(1))
    withpos = join_small(means.withColumn("__one", F.lit(1)), ordered, "__one", "inner", bound=1)
    ids = withpos.select(raw, (F.array_position(F.col("__order"), key) - 1).cast("int").alias(name))
    return frame.join(ids, raw, "left")


def archetype_thresholds(frame: DataFrame, dev_metric: str, trend_metric: str,
                         probs=S.ARCHETYPE_TERTILES) -> DataFrame:
    """Tertile cut points of the two indicators (exact, linear; see ``exact_quantiles``)."""
    from kestrel.operators.quantiles import quantile_row
    return quantile_row(frame, [dev_metric, trend_metric], list(probs), ["dev_low", "dev_high", "pov_low", "pov_high"])


def cluster_profiles(frame: DataFrame, k: int, profile_cols: list[str], dev_metric: str, trend_metric: str,
                     cluster: str = "cluster_id", digits: int = 4) -> DataFrame:
    """Per cluster: size, type counts, rounded means, tier, archetype. The clusters' members are
    :func:`group_members`."""
    aggs = [F.count(F.lit(1)).alias("n_entities"),
            F.count_if(F.col("entity_type") == S.TYPE_CITY).alias("n_city"),
            F.count_if(F.col("entity_type") == S.TYPE_REGENCY).alias("n_regency")]
    aggs += [F.avg(c).alias(f"__m_{c}") for c in profile_cols]
    prof = frame.groupBy(cluster).agg(*aggs)
    th = archetype_thresholds(frame, dev_metric, trend_metric).withColumn("__one", F.lit(1))
    prof = join_small(prof.withColumn("__one", F.lit(1)), th, "__one", "left", bound=1)
    arche = archetype(F.col(f"__m_{dev_metric}"), F.col(f"__m_{trend_metric}"), F.col("dev_low"),
                      F.col("dev_high"), F.col("pov_low"), F.col("pov_high"))
    out = prof.withColumns({"tier": tier_name(cluster, k), "archetype": arche})
    out = out.withColumns({f"mean_{c}": round_half_even(F.col(f"__m_{c}"), digits) for c in profile_cols})
    keep = [cluster, "tier", "archetype", "n_entities", "n_city", "n_regency",
            *[f"mean_{c}" for c in profile_cols]]
    return out.select(*keep)


def attach_cluster_labels(frame: DataFrame, profiles: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return frame.join(profiles.select(cluster, "tier", "archetype"), cluster, "left")


# ------------------------------------------------------------------ statistics
def anova(frame: DataFrame, features: list[str], cluster: str = "cluster_id",
          labels: dict | None = None, with_p: bool = True, digits: int = 4) -> DataFrame:
    """eta squared = SSB/SST and one-way ANOVA F per feature (scale-invariant, so raw
    values give the same result as standardised ones). p from the F tail."""
    labels = labels or {}
    per = frame.groupBy(cluster).agg(*[x for f in features for x in (
        F.count(f).alias(f"n_{f}"), F.avg(f).alias(f"mu_{f}"),
        (F.coalesce(F.var_pop(f), F.lit(0.0)) * F.count(f)).alias(f"ssw_{f}"))])
    totals = frame.agg(*[x for f in features for x in (
        F.count(f).alias(f"tn_{f}"), F.avg(f).alias(f"tm_{f}"), (F.var_pop(f) * F.count(f)).alias(f"tsst_{f}"))])
    totals = totals.withColumn("__one", F.lit(1))
    j = join_small(per.withColumn("__one", F.lit(1)), totals, "__one", "inner", bound=1)
    agg = j.agg(*[x for f in features for x in (
        F.sum(F.col(f"n_{f}") * (F.col(f"mu_{f}") - F.col(f"tm_{f}")) ** 2).alias(f"ssb_{f}"),
        F.sum(f"ssw_{f}").alias(f"ssw_{f}"), F.max(f"tsst_{f}").alias(f"sst_{f}"),
        F.max(f"tn_{f}").alias(f"nt_{f}"), F.count_if(F.col(f"n_{f}") > 0).alias(f"g_{f}"))])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(labels.get(f, f)).alias("label"),
                              F.col(f"ssb_{f}").alias("ssb"), F.col(f"ssw_{f}").alias("ssw"),
                              F.col(f"sst_{f}").alias("sst"), F.col(f"nt_{f}").alias("n"),
                              F.col(f"g_{f}").alias("g")) for f in features])
    long = agg.select(F.inline(rows))
    eta = F.when(F.col("sst") > 0, F.col("ssb") / F.col("sst")).otherwise(F.lit(0.0))
    # one cluster, or as many values as clusters: no F (null), as there is no variance to compare
    fstat = F.try_divide(F.try_divide(F.col("ssb"), F.col("g") - 1), F.try_divide(F.col("ssw"), F.col("n") - F.col("g")))
    out = long.select("feature", "label", round_half_even(eta, digits).alias("eta_squared"),
                      round_half_even(fstat, digits).alias("anova_f"), fstat.alias("__f"),
                      (F.col("g") - 1).alias("__d1"), (F.col("n") - F.col("g")).alias("__d2"))
    if with_p:
        out = out.withColumn("anova_p", round_half_even(anova_p(F.col("__f"), F.col("__d1"), F.col("__d2")), 6))
    return out.drop("__f", "__d1", "__d2")


def two_group_stats(frame: DataFrame, group: str, a: str, b: str, features: list[str],
                    labels: dict | None = None, with_p: bool = True, digits: int = 4) -> DataFrame:
    """Means, Cohen's d (pooled, ddof=1) and Welch two-sided p between groups a and b."""
    labels = labels or {}
    ga, gb = F.col(group) == a, F.col(group) == b
    aggs = []
    for f in features:
        xa, xb = F.when(ga, F.col(f)), F.when(gb, F.col(f))
        aggs += [F.count(xa).alias(f"na_{f}"), F.avg(xa).alias(f"ma_{f}"), F.var_samp(xa).alias(f"va_{f}"),
                 F.count(xb).alias(f"nb_{f}"), F.avg(xb).alias(f"mb_{f}"), F.var_samp(xb).alias(f"vb_{f}")]
    wide = frame.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(labels.get(f, f)).alias("label"),
                              *[F.col(f"{p}_{f}").alias(p) for p in ("na", "ma", "va", "nb", "mb", "vb")])
                     for f in features])
    long = wide.select(F.inline(rows))
    na, nb, ma, mb, va, vb = (F.col(c) for c in ("na", "nb", "ma", "mb", "va", "vb"))
    pooled = F.sqrt(F.try_divide((na - 1) * va + (nb - 1) * vb, na + nb - 2))
    d = (F.when((na < 2) | (nb < 2), F.lit(None).cast("double"))
         .when(pooled == 0, F.lit(0.0)).otherwise((ma - mb) / pooled))
    ea, eb = F.try_divide(va, na), F.try_divide(vb, nb)
    se2 = ea + eb
    t = F.try_divide(ma - mb, F.sqrt(se2))
    df = F.try_divide(se2 * se2, F.try_divide(ea ** 2, na - 1) + F.try_divide(eb ** 2, nb - 1))
    out = long.select("feature", "label",
                      round_half_even(F.when(na > 0, ma), digits).alias(f"mean_{a}"),
                      round_half_even(F.when(nb > 0, mb), digits).alias(f"mean_{b}"),
                      round_half_even(d, digits).alias("cohens_d"),
                      F.when((na >= 2) & (nb >= 2), t).alias("__t"), df.alias("__df"))
    if with_p:
        out = out.withColumn("welch_p", round_half_even(welch_p(F.col("__t"), F.col("__df")), 6))
    return out.drop("__t", "__df")


def adjusted_rand(frame: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index from the contingency table (one row). Where chance agreement leaves no
    room (a single row, or trivial labelings on both sides) it is 1."""
    pairs = lambda c: c * (c - 1) / 2
    cont = frame.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    marg_a = cont.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("sa"))
    marg_b = cont.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("sb"))
    cells = cont.agg(F.sum(pairs(F.col("n"))).alias("sij"), F.sum("n").alias("total"))
    from kestrel.operators.clean import combine_single_rows
    s = combine_single_rows([cells, marg_a, marg_b])
    expected = F.coalesce(F.try_divide(F.col("sa") * F.col("sb"), pairs(F.col("total"))), F.lit(0.0))
    maximum = (F.col("sa") + F.col("sb")) / 2
    ari = F.coalesce(F.try_divide(F.col("sij") - expected, maximum - expected), F.lit(1.0))
    return s.select(ari.alias("adjusted_rand"), F.col("total").alias("n"))


def expectation_check(frame: DataFrame, name_col: str, cluster: str, expected_high: list[str],
                      expected_low: list[str], k: int, min_hits: int = 2) -> DataFrame:
    """Expected names found in the top (0) and bottom (k-1) clusters; pass iff both >= min_hits.
    :func:`expectation_names` lists them."""
    hi = F.col(name_col).isin(*expected_high) & (F.col(cluster) == 0)
    lo = F.col(name_col).isin(*expected_low) & (F.col(cluster) == k - 1)
    res = frame.agg(F.count_if(hi).alias("high_hits"), F.count_if(lo).alias("low_hits"))
    return res.withColumn("passed", (F.col("high_hits") >= min_hits) & (F.col("low_hits") >= min_hits))


def expectation_names(frame: DataFrame, name_col: str, cluster: str, expected_high: list[str],
                      expected_low: list[str], k: int) -> DataFrame:
    """One row per expected name: (side, name, hit). A name that is not in the frame is a miss."""
    wanted = frame.sparkSession.createDataFrame([("high", n) for n in expected_high] + [("low", n) for n in expected_low],
                                                "side string, name string")
    found = (frame.select(F.when(F.col(cluster) == 0, "high").when(F.col(cluster) == k - 1, "low").alias("side"),
                          F.col(name_col).alias("name")).where(F.col("side").isNotNull()).distinct().withColumn("hit", F.lit(True)))
    return wanted.join(found, ["side", "name"], "left").select("side", "name", F.coalesce("hit", F.lit(False)).alias("hit"))
