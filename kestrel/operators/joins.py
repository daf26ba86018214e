"""Join helpers: size-checked broadcast, N-way panel integration, dimension resolution.

Broadcast policy: a side is broadcast by hint only when its row count has a proven
bound (e.g. one row per period inside a fixed analysis period, or k cluster rows).
Otherwise no hint is given: tables read from files are broadcast by the planner only
when their on-disk size is under ``spark.sql.autoBroadcastJoinThreshold``, and
aggregated sides are converted at runtime by AQE from their measured shuffle size.
Either way the fall-back is a shuffle join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 100_000


def join_small(df: DataFrame, small: DataFrame, on, how: str = "inner", bound: int | None = None,
               max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join with ``small`` broadcast when its row count is provably <= ``max_rows``."""
    if bound is not None and bound <= max_rows:
        small = F.broadcast(small)
    return df.join(small, on, how)


def outer_join_all(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Faithful N-way full outer equi-join on ``keys`` (N-1 shuffle joins)."""
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), frames)


def union_aggregate(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Same result as :func:`outer_join_all` when each input has unique keys, in one shuffle.

    Inputs are stacked with ``unionByName(allowMissingColumns=True)`` and collapsed with
    one grouped aggregate; a column absent for a key stays null (value and flag alike).
    Partial aggregation runs map-side, so a hot key is combined before the exchange.
    """
    value_cols: list[str] = []
    for f in frames:
        value_cols += [c for c in f.columns if c not in keys and c not in value_cols]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in value_cols])


def first_non_null_per_key(df: DataFrame, key: str, order: list[Column], cols: list[str]) -> DataFrame:
    """Per key and per column, the first non-null value under ``order``.

    ``min_by`` ignores rows whose ordering is null, so wrapping the ordering in
    ``when(col is not null)`` picks the first *non-null* value column by column.
    The column value itself ends the ordering so ties are deterministic.
    """
    aggs = []
    for c in cols:
        ordering = F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c)))
        aggs.append(F.min_by(F.col(c), ordering).alias(c))
    return df.groupBy(key).agg(*aggs)


def resolve_dimensions(dim_frames: list[DataFrame], key: str, name: str, cols: list[str]) -> DataFrame:
    """Stack per-source dimension rows and keep, per key, the first non-null of each column
    ordered by (name nulls last, name, source order)."""
    cols = [c for c in cols if c != key]
    tagged = [f.select(key, *cols).distinct().withColumn("__src", F.lit(i)) for i, f in enumerate(dim_frames)]
    stacked = reduce(lambda a, b: a.unionByName(b), tagged)
    order = [F.col(name).isNull(), F.col(name), F.col("__src")]
    return first_non_null_per_key(stacked, key, order, cols)
