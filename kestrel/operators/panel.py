"""Panel-level selections: analysis period, latest scored period, cross-section,
complete cases. Guards that must fail loudly use one cheap action each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.spec import PanelSpec


def filter_period(panel: DataFrame, spec: PanelSpec, start: int, end: int, check_empty: bool = False) -> DataFrame:
    """Inclusive period filter. start > end is an error; optionally an empty result too."""
    if start > end:
        raise ValueError("start must be less than or equal to end")
    out = panel.where(F.col(spec.period).between(start, end))
    if check_empty and out.isEmpty():
        raise RuntimeError(f"no rows for period {start}-{end}")
    return out


def latest_scored_period_col(spec: PanelSpec, score: str | None = None) -> Column:
    """Aggregate expression: max period with a non-null score."""
    return F.max(F.when(F.col(score or spec.score_col).isNotNull(), F.col(spec.period)))


def latest_scored_period(panel: DataFrame, spec: PanelSpec, score: str | None = None) -> DataFrame:
    """One-row frame with the latest scored period (null if none) — joinable, no collect."""
    return panel.agg(latest_scored_period_col(spec, score).alias(spec.period))


def resolve_period(panel: DataFrame, spec: PanelSpec, requested: int | None = None) -> int:
    """Explicit period wins; else the latest scored one (one tiny aggregate action)."""
    if requested is not None:
        return int(requested)
    value = latest_scored_period(panel, spec).first()[0]
    if value is None:
        raise RuntimeError("no scored period available")
    return int(value)


def cross_section(panel: DataFrame, spec: PanelSpec, period: int | None = None,
                  latest: bool = False) -> DataFrame:
    """Rows of one period. With ``latest`` the period is resolved inside the plan
    (semi join against the one-row latest-period aggregate), so nothing is collected."""
    if latest:
        return panel.join(latest_scored_period(panel, spec), spec.period, "left_semi")
    return panel.where(F.col(spec.period) == F.lit(period))


def complete_cases(df: DataFrame, features: list[str]) -> DataFrame:
    return df.dropna(subset=list(features))


def case_counts(df: DataFrame, features: list[str]) -> DataFrame:
    """One row: rows, complete rows, rows dropped for a missing feature."""
    whole = F.count_if(reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in features]))
    return df.agg(F.count(F.lit(1)).alias("rows"), whole.alias("complete"), (F.count(F.lit(1)) - whole).alias("dropped"))


def require_cases(snapshot: DataFrame, features: list[str], least: int = 3) -> int:
    """Guard of a modelling snapshot (one small action): it must have rows, and at least ``least``
    complete ones. Returns the number of rows dropped for a missing feature."""
    counts = case_counts(snapshot, features).first()
    if not counts["rows"]:
        raise RuntimeError("the snapshot has no rows")
    if counts["complete"] < least:
        raise RuntimeError(f"only {counts['complete']} complete rows, at least {least} are needed ({counts['dropped']} dropped)")
    return counts["dropped"]
