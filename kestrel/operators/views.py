"""Report views: reshapes (melt / pivot), min-max profiles, effect view, headline KPIs,
ordered lists with sequence numbers, membership filters, display strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.joins import join_small
from kestrel.session import cut_lineage

# Side labels of the effect-size view.
SIDE_A = "Lebih tinggi di urban-industri"
SIDE_B = "Lebih tinggi di rural-agraris"


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("__one", F.lit(1))


def melt(df: DataFrame, ids: list[str], values: list[str], var: str = "indicator", value: str = "value") -> DataFrame:
    """Wide → long; nulls are kept (like pandas melt)."""
    return df.unpivot(ids, values, var, value)


def pivot_counts(df: DataFrame, row: str, col: str, col_values: list[str], row_values: list[str] | None = None) -> DataFrame:
    """row x col counts with explicit column values (single pass), missing → 0."""
    out = df.groupBy(row).pivot(col, col_values).count().fillna(0, subset=col_values)
    if row_values is not None:
        out = out.where(F.col(row).isin(*row_values))
    return out


def pivot_values(df: DataFrame, row: str, col: str, value: str, col_values: list) -> DataFrame:
    return df.groupBy(row).pivot(col, col_values).agg(F.max(value))  # one value per cell


def minmax_normalize(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - min) / (max - min) per column across rows; a constant column → null."""
    stats = df.agg(*[x for c in cols for x in (F.min(c).alias(f"__lo_{c}"), F.max(c).alias(f"__hi_{c}"))])
    j = join_small(_one(df), _one(stats), "__one", "inner", bound=1)
    out = j.withColumns({c: F.try_divide(F.col(c) - F.col(f"__lo_{c}"), F.col(f"__hi_{c}") - F.col(f"__lo_{c}"))
                         for c in cols})
    return out.select(*df.columns)


def effect_view(effects: DataFrame, d: str = "cohens_d") -> DataFrame:
    return effects.withColumns({"strength": F.abs(F.col(d)),
                                "side": F.when(F.col(d) > 0, SIDE_A).otherwise(SIDE_B)})


def latest_and_previous(series: DataFrame, order: str, value_cols: list[str]) -> DataFrame:
    """One row: the last and the previous row of a small ordered series and the deltas."""
    last = series.agg(F.max_by(F.struct(order, *value_cols), F.col(order)).alias("__l"))
    j = join_small(_one(series), _one(last), "__one", "inner", bound=1)
    prev = j.where(F.col(order) < F.col(f"__l.{order}")).agg(
        F.max_by(F.struct(order, *value_cols), F.col(order)).alias("__p"))
    both = join_small(_one(last), _one(prev), "__one", "left", bound=1)
    cols = [F.col(f"__l.{order}").alias(order), F.col(f"__p.{order}").alias(f"previous_{order}")]
    for v in value_cols:
        cols += [F.col(f"__l.{v}").alias(v), (F.col(f"__l.{v}") - F.col(f"__p.{v}")).alias(f"{v}_delta")]
    return both.select(*cols)


def global_ordinal(df: DataFrame, score: str, tie: str, name: str = "order_no") -> DataFrame:
    """1..n sequence by (score desc, nulls last, tie asc) without a single-partition window.

    Rows are range-partitioned by the whole order (so neither an outlier nor a common score fills
    one task) and written once; the partitions' sizes, one row each, give every partition its
    first number, and rows are numbered inside their partition only."""
    order = [F.col(score).desc_nulls_last(), F.col(tie).asc()]
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.join(offsets, "__part").withColumn(name, (F.col("__off") + within).cast("bigint")).drop("__part", "__off")


def members_filter(df: DataFrame, col: str, values: list, period: str | None = None,
                   start: int | None = None, end: int | None = None) -> DataFrame:
    cond: Column = F.col(col).isin(*values)
    if period is not None:
        cond = cond & F.col(period).between(start, end)
    return df.where(cond)
