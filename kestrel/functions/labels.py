"""Label rules as native Column expressions (CASE chains and map literals)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from kestrel import spec as S


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def trend_direction(delta: Column | str, threshold: float = S.TREND_DELTA_THRESHOLD) -> Column:
    """Period-over-period direction from the raw (unrounded) change."""
    d = _col(delta)
    return (
        F.when(d > threshold, S.TREND_UP)
        .when(d < -threshold, S.TREND_DOWN)
        .when(d.isNotNull(), S.TREND_FLAT)
        .otherwise(S.TREND_NO_BASE)
    )


def slope_label(slope: Column | str, tolerance: float = S.SLOPE_TOLERANCE) -> Column:
    """Trend label from a slope that is already rounded to 4 dp."""
    s = _col(slope)
    return (
        F.when(s.isNull(), S.SLOPE_UNKNOWN)
        .when(s > tolerance, S.SLOPE_WORSE)
        .when(s < -tolerance, S.SLOPE_BETTER)
        .otherwise(S.SLOPE_FLAT)
    )


def priority_bucket(pct: Column | str) -> Column:
    """Fixed right-closed bins over the percent rank; the lowest edge (0) is included."""
    p = _col(pct)
    out = None
    for edge, label in S.PRIORITY_BUCKETS:
        cond = (p >= 0) & (p <= edge)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def tier_name(cluster_id: Column | str, k: int) -> Column:
    """Vulnerability tier by cluster rank (0 = most vulnerable)."""
    c = _col(cluster_id)
    if k == 3:
        return F.element_at(F.array(*[F.lit(n) for n in S.TIER_NAMES_K3]), c.cast("int") + 1)
    return (
        F.when(c == 0, S.TIER_TOP)
        .when(c == k - 1, S.TIER_BOTTOM)
        .otherwise(F.concat(F.lit(S.TIER_MIDDLE_PREFIX), c.cast("string")))
    )


def entity_type(name: Column | str, prefix: str = S.CITY_PREFIX,
                when_true: str = S.TYPE_CITY, when_false: str = S.TYPE_REGENCY) -> Column:
    return F.when(_col(name).startswith(prefix), when_true).otherwise(when_false)


def priority_action(level: Column | str, trend: Column | str) -> Column:
    """12-cell (level, trend) lookup as a map literal; unmatched cells fall back to default."""
    m = F.create_map(*chain.from_iterable(
        (F.lit(f"{lv}|{tr}"), F.lit(act)) for (lv, tr), act in S.PRIORITY_ACTION.items()))
    key = F.concat_ws("|", _col(level), _col(trend))
    return F.coalesce(F.element_at(m, key), F.lit(S.PRIORITY_DEFAULT))


def archetype(mean_dev: Column, mean_pov: Column, dev_low: Column, dev_high: Column,
              pov_low: Column, pov_high: Column) -> Column:
    """Economic archetype of a cluster from its means against tertile cut points (inclusive)."""
    return (
        F.when((mean_dev >= dev_high) & (mean_pov <= pov_low), S.ARCHETYPE_URBAN)
        .when((mean_dev <= dev_low) & (mean_pov >= pov_high), S.ARCHETYPE_RURAL)
        .otherwise(S.ARCHETYPE_MIXED)
    )
