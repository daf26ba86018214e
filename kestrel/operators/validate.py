"""Named data-quality checks over a scored panel, fused into few aggregate passes.

The panel is scanned once for every counter that is a plain conditional count; the two
duplicate checks need their own grouped aggregates. The single result row is then
stacked into (check_name, status, value, expectation) rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel import spec as S
from kestrel.operators.clean import combine_single_rows, duplicate_stats
from kestrel.spec import PanelSpec


def status(ok: Column, warn: bool = False) -> Column:
    return F.when(ok, F.lit(S.PASS)).otherwise(F.lit(S.WARN if warn else S.FAIL))


def domain_violation(m) -> Column:
    """Non-null value outside the metric's declared domain."""
    c = F.col(m.name)
    ok = F.lit(True)
    if m.low is not None:
        ok = ok & ((c > m.low) if m.low_strict else (c >= m.low))
    if m.high is not None:
        ok = ok & (c <= m.high)
    return c.isNotNull() & ~ok


@dataclass(frozen=True)
class Check:
    name: str
    status: Column
    value: Column
    expectation: str


def panel_counters(panel: DataFrame, spec: PanelSpec, rank: str = "priority_rank",
                   components: str = "n_score_components") -> DataFrame:
    """One-row frame of every counter the checks need."""
    k = len(spec.risk_metrics)
    score = F.col(spec.score_col)
    aggs = [
        (F.count_if(F.col(spec.entity).isNull()) + F.count_if(F.col(spec.period).isNull())).alias("missing_keys"),
        sum((F.count_if(F.col(d).isNull()) for d in spec.dims), F.lit(0)).alias("missing_dims"),
        F.count_distinct(spec.entity).alias("n_entities"),
        F.min(spec.period).alias("period_min"),
        F.max(spec.period).alias("period_max"),
        F.max(F.when(score.isNotNull(), F.col(spec.period))).alias("latest_scored"),
        F.count_if((F.col(components) < k) & score.isNotNull()).alias("incomplete_with_score"),
        F.count_if((F.col(components) == k) & score.isNull()).alias("complete_without_score"),
        F.count_if(score.isNotNull() & F.col(rank).isNull()).alias("score_without_rank"),
        F.count_if(score.isNull() & F.col(rank).isNotNull()).alias("rank_without_score"),
    ]
    for m in spec.metrics:
        aggs.append(F.count_if(domain_violation(m)).alias(f"invalid_{m.name}"))
        aggs.append(F.count_if(F.col(m.name) == 0).alias(f"zeros_{m.name}"))
    main = panel.agg(*aggs)
    dups = duplicate_stats(panel, spec.keys).select(F.col("duplicate_key_surplus").alias("duplicate_keys"),
                                                    F.col("exact_duplicate_rows").alias("exact_duplicates"))
    return combine_single_rows([main, dups])


def validation_checks(panel: DataFrame, spec: PanelSpec, required: list[str] | None = None) -> DataFrame:
    """17 named checks (for a 5-metric spec) as rows; statuses PASS / WARN / FAIL."""
    required = required if required is not None else [*spec.dims, spec.period, *spec.metric_names]
    missing = [c for c in required if c not in panel.columns]
    # an absent column fails the first check; the others see it as all missing
    for c in missing:
        metric = c in spec.metric_names
        panel = panel.withColumn(c, F.lit(None).cast("double" if metric else "bigint" if c in spec.keys else "string"))
    cnt = panel_counters(panel, spec)
    s = lambda n: F.col(n).cast("string")
    period_range = F.concat_ws("-", s("period_min"), s("period_max"))
    checks = [
        Check("required_columns_present", F.lit(S.PASS if not missing else S.FAIL),
              F.lit(", ".join(missing) if missing else "all present"),
              "Every dimension, key and metric column exists."),
        Check("unique_entity_period_key", status(F.col("duplicate_keys") == 0), s("duplicate_keys"),
              "No duplicate (entity, period) rows."),
        Check("no_exact_duplicate_rows", status(F.col("exact_duplicates") == 0), s("exact_duplicates"),
              "No exact duplicate rows."),
        Check("no_missing_key_values", status(F.col("missing_keys") == 0), s("missing_keys"),
              "No missing entity or period."),
        Check("no_missing_dimension_values", status(F.col("missing_dims") == 0), s("missing_dims"),
              "No missing dimension values."),
        Check("expected_entity_count",
              status(F.col("n_entities") == F.lit(spec.expected_entities), warn=True)
              if spec.expected_entities is not None else F.lit(S.PASS),
              s("n_entities"), f"Expected {spec.expected_entities} entities in the panel."),
        Check("period_range_available", F.lit(S.PASS), period_range,
              "Record the available period range; metrics need not cover every period."),
        Check("analysis_period_matches_scope",
              status((F.col("period_min") == F.lit(spec.period_start)) & (F.col("period_max") == F.lit(spec.period_end))),
              period_range, f"Panel should span the analysis scope {spec.period_start}-{spec.period_end}."),
    ]
    for m in spec.metrics:
        checks.append(Check(f"{m.name}_domain_range", status(F.col(f"invalid_{m.name}") == 0),
                            s(f"invalid_{m.name}"), "Non-null values lie inside the declared domain."))
    zero_total = sum((F.col(f"zeros_{m.name}") for m in spec.metrics), F.lit(0))
    zero_text = F.concat_ws("; ", *[F.concat(F.lit(f"{m.name}="), s(f"zeros_{m.name}")) for m in spec.metrics])
    checks += [
        Check("no_zero_placeholders_remaining", status(zero_total == 0), zero_text,
              "Zero placeholders were converted to missing values."),
        Check("latest_scored_period_exists", status(F.col("latest_scored").isNotNull()), s("latest_scored"),
              "At least one period has a complete score."),
        Check("score_only_when_components_complete",
              status((F.col("incomplete_with_score") == 0) & (F.col("complete_without_score") == 0)),
              F.concat(F.lit("incomplete_with_score="), s("incomplete_with_score"),
                       F.lit("; complete_without_score="), s("complete_without_score")),
              f"The score exists only when all {len(spec.risk_metrics)} risk components exist."),
        Check("priority_rank_matches_score_availability",
              status((F.col("score_without_rank") == 0) & (F.col("rank_without_score") == 0)),
              F.concat(F.lit("score_without_rank="), s("score_without_rank"),
                       F.lit("; rank_without_score="), s("rank_without_score")),
              "A rank exists exactly when a score exists."),
    ]
    rows = F.array(*[F.struct(F.lit(i).alias("check_order"), F.lit(c.name).alias("check_name"),
                              c.status.alias("status"), c.value.alias("value"),
                              F.lit(c.expectation).alias("expectation"))
                     for i, c in enumerate(checks, start=1)])
    return cnt.select(F.inline(rows))


def coverage_by_period(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Non-null count of each metric per period."""
    return panel.groupBy(spec.period).agg(*[F.count(m).alias(m) for m in spec.metric_names])


def raise_on_failure(checks: DataFrame) -> DataFrame:
    """Abort (one small action: the checks are a list of fixed size) if any check failed, naming
    every failed one; returns the checks unchanged."""
    failed = checks.where(F.col("status") == S.FAIL).select("check_name").collect()
    if failed:
        raise RuntimeError(f"validation failed: {[r[0] for r in failed]}")
    return checks


def assert_panel(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Inline guard after integration: required metric columns, no null keys, unique
    keys. Two small aggregate actions; raises on violation, returns the panel."""
    missing = [m for m in spec.metric_names if m not in panel.columns]
    if missing:
        raise RuntimeError(f"panel missing metric columns: {missing}")
    row = panel.agg((F.count_if(F.col(spec.entity).isNull()) + F.count_if(F.col(spec.period).isNull())).alias("k")).first()
    if row.k:
        raise RuntimeError(f"panel has missing keys: {row.k}")
    dups = (panel.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d")).first().d)
    if dups:
        raise RuntimeError(f"panel has duplicate keys: {dups}")
    return panel
