"""Panel features: change, rolling mean, within-period z-scores, composite score, ranks.

Scale notes
-----------
* Entity-ordered features (lag / rolling) share one exchange on the entity key. Where the
  periods span more than one segment (see ``segments``) an entity's series is cut into
  segments, so one entity that holds a third of all rows spreads over tasks.
* Per-period statistics never use a window partitioned by period (that would put a
  whole period, possibly a third of the data, in one task). They are aggregates with
  map-side partial aggregation, joined back to the panel.
* Ranks within a period are computed over the *distinct* (period, score) values with
  their multiplicities, in two levels: inside buckets of the score, and over the buckets'
  sums. The score is rounded to ``spec.score_digits``, so a bucket has at most
  RANK_BUCKET distinct values, and no task ever holds a period's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel import spec as S
from kestrel.functions.numeric import round_half_even
from kestrel.functions.labels import priority_bucket, trend_direction
from kestrel.operators import segments as SG
from kestrel.operators.joins import join_small
from kestrel.session import cut_lineage
from kestrel.spec import PanelSpec


RANK_BUCKET = 1 << 16  # distinct rounded scores of a period that one task may hold


def entity_window(spec: PanelSpec):
    return Window.partitionBy(spec.entity).orderBy(spec.period)


def add_changes(df: DataFrame, spec: PanelSpec, metrics: list[str] | None = None, segment: Column | None = None) -> DataFrame:
    """Previous-row difference and percent change per entity (null if either side null)."""
    w = entity_window(spec)
    cols = {}
    names = metrics or spec.metric_names
    if segment is not None:
        df = SG.previous_rows(df, [spec.entity], [spec.period], names, 2, segment)
        before = F.when(F.size("__rows") > 1, F.element_at("__rows", 1))
    for m in names:
        prev = F.lag(m).over(w) if segment is None else before[m]
        cols[f"{m}_yoy_change"] = F.col(m) - prev
        cols[f"{m}_yoy_pct_change"] = F.try_divide(F.col(m) - prev, prev) * F.lit(100.0)
    return df.withColumns(cols).drop("__rows")


def add_rolling_mean(df: DataFrame, spec: PanelSpec, metric: str | None = None,
                     window: int | None = None, name: str | None = None, segment: Column | None = None) -> DataFrame:
    """Trailing mean over the last ``window`` rows, nulls skipped (min_periods=1)."""
    metric = metric or spec.trend
    n = window or spec.rolling_window
    if segment is not None:
        rows = SG.previous_rows(df, [spec.entity], [spec.period], [metric], n, segment)
        known = F.filter(F.transform("__rows", lambda x: x[metric].cast("double")), lambda v: v.isNotNull())
        mean = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, v: a + v), F.size(known))
        return rows.withColumn(name or f"{metric}_rolling_{n}", mean).drop("__rows")
    w = entity_window(spec).rowsBetween(-(n - 1), Window.currentRow)
    return df.withColumn(name or f"{metric}_rolling_{n}", F.avg(metric).over(w))


def add_trend_direction(df: DataFrame, spec: PanelSpec, name: str = "trend_direction") -> DataFrame:
    delta = f"{spec.trend}_yoy_change"
    if delta not in df.columns:
        df = add_changes(df, spec, [spec.trend])
    return df.withColumn(name, trend_direction(F.col(delta)))


def period_stats(df: DataFrame, spec: PanelSpec, metrics: list[str]) -> DataFrame:
    """Mean and population std per period (one partial aggregate, tiny output)."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"__mu_{m}"), F.stddev_pop(m).alias(f"__sd_{m}")]
    return df.groupBy(spec.period).agg(*aggs)


def zscore_expr(m: str) -> Column:
    mu, sd = F.col(f"__mu_{m}"), F.col(f"__sd_{m}")
    return (
        F.when(F.col(m).isNull(), F.lit(None).cast("double"))
        .when(sd.isNull() | (sd == 0), F.lit(0.0))
        .otherwise((F.col(m) - mu) / sd)
    )


def add_zscores(df: DataFrame, spec: PanelSpec, metrics: list[str] | None = None,
                suffix: str = "_z", risk_oriented: bool = False) -> DataFrame:
    """Within-period z-score (ddof=0); constant period → 0.0; null stays null.

    With ``risk_oriented`` the sign is flipped for ``low_is_risky`` metrics and
    context-only metrics are skipped.
    """
    if metrics is None:
        metrics = [m.name for m in (spec.risk_metrics if risk_oriented else spec.metrics)]
    stats = period_stats(df, spec, metrics)
    out = df.join(stats, [spec.period], "left")  # one row per period: broadcast by its size at run time
    cols = {}
    for m in metrics:
        z = zscore_expr(m)
        if risk_oriented and spec.metric(m).risk == S.LOW_IS_RISKY:
            z = -z
        cols[f"{m}{suffix}"] = z
    out = out.withColumns(cols)
    return out.drop(*[c for c in out.columns if c.startswith("__mu_") or c.startswith("__sd_")])


def add_risk_zscores(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return add_zscores(df, spec, suffix="_risk_z", risk_oriented=True)


def add_composite_score(df: DataFrame, spec: PanelSpec, count_name: str = "n_score_components") -> DataFrame:
    """Mean of all risk z-scores, null unless every component is present; rounded."""
    zs = [F.col(f"{m.name}_risk_z") for m in spec.risk_metrics]
    n_present = sum((F.when(z.isNotNull(), 1).otherwise(0) for z in zs), F.lit(0))
    total = zs[0]
    for z in zs[1:]:
        total = total + z
    return df.withColumns({
        count_name: n_present.cast("int"),
        spec.score_col: round_half_even(total / F.lit(float(len(zs))), spec.score_digits),
    })


def rank_table(df: DataFrame, spec: PanelSpec, score: str | None = None,
               rank_name: str = "priority_rank", pct_name: str = "priority_pct") -> DataFrame:
    """(period, score) → dense rank (desc) and min-rank / count, from distinct values."""
    score = score or spec.score_col
    distinct = (df.where(F.col(score).isNotNull())
                .groupBy(spec.period, score).agg(F.count(F.lit(1)).alias("__n")))
    # bucket 0 holds the scores around zero; a bucket is RANK_BUCKET steps of the rounded score wide
    distinct = distinct.withColumn("__bucket", F.floor(F.col(score) * F.lit(float(10 ** spec.score_digits)) / F.lit(float(RANK_BUCKET))))
    inside = Window.partitionBy(spec.period, "__bucket").orderBy(F.col(score).desc())
    higher = Window.partitionBy(spec.period).orderBy(F.col("__bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    buckets = distinct.groupBy(spec.period, "__bucket").agg(F.count(F.lit(1)).alias("__d"), F.sum("__n").alias("__s"))
    carry = buckets.select(spec.period, "__bucket", F.coalesce(F.sum("__d").over(higher), F.lit(0)).alias("__ranks"),
                           F.coalesce(F.sum("__s").over(higher), F.lit(0)).alias("__above"),
                           F.sum("__s").over(Window.partitionBy(spec.period)).alias("__total"))
    before = F.coalesce(F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = distinct.select(spec.period, score, "__bucket", F.row_number().over(inside).alias("__rank"), before.alias("__before"))
    return placed.join(carry, [spec.period, "__bucket"]).select(
        spec.period, score,
        (F.col("__ranks") + F.col("__rank")).cast("bigint").alias(rank_name),
        ((F.col("__above") + F.col("__before") + 1) / F.col("__total")).alias(pct_name),
    )


def add_ranks(df: DataFrame, spec: PanelSpec, score: str | None = None,
              rank_name: str = "priority_rank", pct_name: str = "priority_pct",
              strategy: str = "distinct") -> DataFrame:
    """Dense rank (desc, null score → null rank) and pandas-style pct rank (method=min).

    ``strategy="distinct"`` (default, scale-safe) ranks distinct values and joins back;
    ``strategy="window"`` is the direct per-period window, kept as a cross-check.
    """
    score = score or spec.score_col
    if strategy == "window":
        w = Window.partitionBy(spec.period).orderBy(F.col(score).desc_nulls_last())
        has = F.col(score).isNotNull()
        cnt = F.count(score).over(Window.partitionBy(spec.period))
        return df.withColumns({
            rank_name: F.when(has, F.dense_rank().over(w)).cast("bigint"),
            pct_name: F.when(has, F.rank().over(w) / cnt),
        })
    ranks = (rank_table(df, spec, score, rank_name, pct_name).withColumnRenamed(score, "__key")
             .withColumn("__scored", F.lit(True)))
    # Unscored rows cannot match a rank; instead of one null key (one hot shuffle
    # partition for a large unscored group) each gets a hashed salt and a flag that no
    # rank row carries.
    salt = (F.xxhash64(*[F.col(c) for c in spec.keys]) % 4096).cast("double")
    keyed = df.withColumns({"__key": F.coalesce(F.col(score), salt), "__scored": F.col(score).isNotNull()})
    return keyed.join(ranks, [spec.period, "__key", "__scored"], "left").drop("__key", "__scored")


def add_priority_bucket(df: DataFrame, pct: str = "priority_pct", name: str = "priority_bucket") -> DataFrame:
    return df.withColumn(name, priority_bucket(pct))


def add_row_reductions(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Counts across columns: imputed flags (null flag = 0) and available metrics."""
    flags = [f"{m}_was_imputed" for m in spec.metric_names if f"{m}_was_imputed" in df.columns]
    n_imp = sum((F.coalesce(F.col(f), F.lit(False)).cast("int") for f in flags), F.lit(0))
    n_avail = sum((F.col(m).isNotNull().cast("int") for m in spec.metric_names), F.lit(0))
    return df.withColumns({"n_imputed": n_imp.cast("int"), "n_available": n_avail.cast("int")})


def add_features(panel: DataFrame, spec: PanelSpec, rank_strategy: str = "distinct",
                 materialize: bool = False, segment_width: int = SG.WIDTH) -> DataFrame:
    """All panel features in dependency order (mirrors the scrub stage's feature step).

    The feature plan reads the panel more than once (per-period statistics, ranks), so
    with ``materialize`` the panel is written once to the shared folder and the upstream work
    runs once. (A file hand-off does not keep a hash partitioning, so no repartition is done
    before it: the entity windows shuffle once either way.)
    """
    segment = None
    if materialize:
        panel = cut_lineage(panel)
        segment = SG.segment_of(panel, spec.period, segment_width)
    out = add_changes(panel, spec, segment=segment)
    out = add_rolling_mean(out, spec, segment=segment)
    out = add_trend_direction(out, spec)
    out = add_risk_zscores(out, spec)
    out = add_composite_score(out, spec)
    out = add_ranks(out, spec, strategy=rank_strategy)
    out = add_priority_bucket(out)
    out = add_row_reductions(out, spec)
    return out.drop("priority_pct")


def sort_panel(df: DataFrame, spec: PanelSpec, rank: str = "priority_rank") -> DataFrame:
    """Output order at the sink only: period, rank (nulls last), entity."""
    return df.orderBy(F.col(spec.period), F.col(rank).asc_nulls_last(), F.col(spec.entity))
