"""Feature dictionary generated from a panel spec: one row per output column with a
description and its source (metadata only; no data is read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.spec import PanelSpec

DERIVED = (
    ("trend_direction", "Direction of the trend metric's change from the previous row", "derived"),
    ("n_score_components", "Risk components available for the composite score", "derived"),
    ("score", "Mean of the risk-oriented within-period z-scores (all components required)", "derived"),
    ("priority_rank", "Dense rank of the score within the period, highest first", "derived"),
    ("priority_bucket", "Priority class from the percent rank of the score", "derived"),
    ("n_imputed", "Metrics filled by interpolation in this row", "derived"),
    ("n_available", "Metrics present in this row", "derived"),
)


def dictionary_rows(spec: PanelSpec, rolling: int = 3) -> list[tuple[str, str, str]]:
    rows = [(d, f"Dimension {d}", "dimension") for d in spec.dims]
    rows.append((spec.period, "Period", "key"))
    for m in spec.metrics:
        src = m.name
        rows += [
            (m.name, f"{m.label or m.name} ({m.unit})" if m.unit else (m.label or m.name), src),
            (f"{m.name}_was_imputed", f"{m.label or m.name} filled by interior interpolation", src),
            (f"{m.name}_yoy_change", f"{m.label or m.name}: change from the previous period", src),
            (f"{m.name}_yoy_pct_change", f"{m.label or m.name}: percent change from the previous period", src),
        ]
    rows.append((f"{spec.trend}_rolling_{rolling}", f"Trailing {rolling}-period mean of {spec.trend}", spec.trend))
    rows += list(DERIVED)
    return rows


def feature_dictionary(spark: SparkSession, spec: PanelSpec) -> DataFrame:
    return spark.createDataFrame(dictionary_rows(spec), "column string, description string, source string")
