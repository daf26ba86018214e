"""Scrub stage: typing, key hygiene, deduplication, zero-as-missing, interpolation, profile.

All steps are Column expressions, grouped aggregates or entity-partitioned windows.

Scale notes
-----------
* Keep-last deduplication is a grouped ``max_by`` (reduced per task before the exchange), not a
  ``row_number`` window: a key holding a third of all rows is combined before the
  exchange instead of being sorted inside one task.
* Interpolation needs the neighbours on both sides; the "next known value" is taken
  from a descending-ordered window with a growing frame (linear), never from an
  ``UNBOUNDED FOLLOWING`` frame (quadratic per partition). Entities whose periods span
  several segments are scanned in two levels (``segments``), not in one task.
* A source's profile and its cleaned rows come from one scan (see ``clean_dataset``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from kestrel import spec as S
from kestrel.operators import segments as SG
from kestrel.functions.text import coerce_numeric, normalize_name, standardize_columns


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def require_columns(df: DataFrame, required: list[str], what: str = "input") -> None:
    """Driver-side schema check (metadata only)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} missing required columns: {missing}")


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def with_default_dims(df: DataFrame, defaults: dict) -> DataFrame:
    """Add absent dimension columns as literals; fill nulls of present ones."""
    cols = {}
    for name, value in defaults.items():
        cols[name] = F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
    return df.withColumns(cols)


def typed_key(c: Column | str, dtype=None) -> Column:
    """Coerce a key to bigint; a non-integral value raises instead of truncating. Integral types
    and integral text never pass through a double, which would alter keys above 2**53."""
    if isinstance(dtype, IntegralType):
        return _c(c).cast("bigint")
    v = coerce_numeric(_c(c), dtype)
    bad = v.isNotNull() & (v != F.floor(v))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("non-integer key value: "), v.cast("string")))).otherwise(v).cast("bigint")
    if isinstance(dtype, NumericType):
        return checked
    text = F.trim(_c(c).cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint")).otherwise(checked)


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def count_null_keys(keys: list[str]) -> Column:
    return F.count_if(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def dimension_filter(df: DataFrame, col: str, value) -> DataFrame:
    """Keep rows whose dimension is null or equal to the expected constant."""
    return df.where(F.col(col).isNull() | (F.col(col) == F.lit(value)))


def zero_to_missing(df: DataFrame, metric: str) -> DataFrame:
    return df.withColumn(metric, F.nullif(F.col(metric), F.lit(0.0)))


def count_zeros(metric: str) -> Column:
    return F.count_if(F.col(metric).isNotNull() & (F.col(metric) == 0))


def null_cells(cols: list[str]) -> Column:
    """Number of null cells across ``cols`` (pandas ``isna().sum().sum()``)."""
    return reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in cols])


# ------------------------------------------------------------------ deduplication
def exact_dedup(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (null equals null)."""
    return df.dropDuplicates()


def duplicate_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, exact duplicate rows, rows in duplicated key groups (all members),
    surplus rows per key (all but the first), distinct keys.

    One scan: equal rows are counted first (with partial counts before the shuffle, so a row that
    is repeated very often arrives once per task), the distinct rows are then summed per key."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    by_key = rows.groupBy(*keys).agg(F.sum("__c").alias("__n"), F.sum(F.col("__c") - 1).alias("__again"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return by_key.agg(zero(F.when(F.col("__n") > 1, F.col("__n")).otherwise(0)).alias("duplicate_key_rows"),
                      zero(F.col("__n") - 1).alias("duplicate_key_surplus"), F.count(F.lit(1)).alias("distinct_keys"),
                      zero(F.col("__n")).alias("rows"), zero(F.col("__again")).alias("exact_duplicate_rows"))


def combine_single_rows(frames: list[DataFrame]) -> DataFrame:
    """Side-by-side combination of one-row aggregates without a cross join."""
    tagged = [f.withColumn("__one", F.lit(1)) for f in frames]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    value_cols = [c for c in stacked.columns if c != "__one"]
    return stacked.groupBy("__one").agg(*[F.max(c).alias(c) for c in value_cols]).drop("__one")


def last_row(rest: list[str], order: list[str], when: Column | None = None) -> Column:
    """Aggregate: the last row of a group under ``order`` ascending, nulls sorted last (so a null
    in the first order column wins); the remaining columns break ties. ``when`` limits the rows."""
    tie = [c for c in rest if c not in order]
    ordering = F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"{c}__null"), F.col(c))], *[F.col(c) for c in tie])
    row = F.struct(*[F.col(c) for c in rest])
    # max_by over a struct is no hash aggregate: each task sorts its rows by key, but hot keys are
    # still reduced to one row before the shuffle. Sorting once after the exchange instead would
    # carry every repeated row through it.
    return F.max_by(row, ordering if when is None else F.when(when, ordering))


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last row under ``order`` (see :func:`last_row`). ``order`` is required:
    without an id pass an ingest ordinal (``sources.files.with_ingest_order``)."""
    if not order:
        raise ValueError("keep_last needs an order: an id column or an ingest ordinal")
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(last_row(rest, order).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


# ------------------------------------------------------------------ interpolation
def interpolate_linear(df: DataFrame, entity: str | list[str], order: list[str], value: str,
                       out: str | None = None, segment: Column | None = None, tasks: int | None = None) -> DataFrame:
    """Interior linear interpolation by row position within each entity.

    Only gaps with a known value on both sides are filled; leading/trailing gaps stay
    null. Position, not the order value, is the x-axis. With ``segment`` (see
    ``segments.segment_of``) no entity need fit one task. With ``tasks`` the rows are dealt
    over so many of them, else over as many as their bytes ask for.
    """
    out = out or value
    groups = [entity] if isinstance(entity, str) else entity
    if segment is not None:
        return SG.interpolate(df, groups, order, value, out, segment, tasks)
    df = df.repartition(tasks, *groups) if tasks else df
    asc = Window.partitionBy(*groups).orderBy(*[F.col(c) for c in order])
    desc = Window.partitionBy(*groups).orderBy(*[F.col(c).desc() for c in order])
    before = asc.rowsBetween(Window.unboundedPreceding, -1)
    after = desc.rowsBetween(Window.unboundedPreceding, -1)
    known_pos = F.when(F.col(value).isNotNull(), F.col("__pos"))
    staged = df.withColumn("__pos", F.row_number().over(asc))
    staged = staged.withColumns({
        "__pv": F.last(value, ignorenulls=True).over(before),
        "__pi": F.last(known_pos, ignorenulls=True).over(before),
        "__nv": F.last(value, ignorenulls=True).over(after),
        "__ni": F.last(known_pos, ignorenulls=True).over(after),
    })
    frac = (F.col("__pos") - F.col("__pi")) / (F.col("__ni") - F.col("__pi"))
    filled = F.when(F.col(value).isNotNull(), F.col(value)) \
        .when(F.col("__pv").isNotNull() & F.col("__nv").isNotNull(),
              F.col("__pv") + (F.col("__nv") - F.col("__pv")) * frac)
    return staged.withColumn(out, filled).drop("__pos", "__pv", "__pi", "__nv", "__ni")


# ------------------------------------------------------------------ clean stage
@dataclass(frozen=True)
class DatasetSpec:
    """One long-format metric source (entity, period, metric [, id, dims])."""
    name: str
    metric: str
    entity: str
    period: str
    entity_name: str | None = None
    id_col: str | None = None
    order_col: str | None = None       # ingest ordinal, for sources without an id: the last row wins
    zero_is_missing: bool = True
    dims: tuple[str, ...] = ()
    dim_filter: tuple[str, object] | None = None
    defaults: tuple[tuple[str, object], ...] = ()
    int_cols: tuple[str, ...] = ()     # further integer columns (typed like keys)
    name_cols: tuple[str, ...] = ()    # further name columns (normalised like the entity name)
    extra_cols: tuple[str, ...] = ()   # kept for the profile only (e.g. a unit column)
    segment_width: int = SG.WIDTH      # periods of one entity that one task may hold
    task_rows: int = SG.TASK_ROWS      # rows, about, that one task of the entity windows holds


def clean_dataset(raw: DataFrame, ds: DatasetSpec) -> tuple[DataFrame, DataFrame]:
    """Scrub one metric source. Returns (cleaned rows, one-row quality profile), both lazy.

    Order of steps: standardise names -> required columns -> defaults -> subset -> typing
    -> drop null keys -> dimension filter -> exact dedup -> keep-last per key ->
    zero-as-missing -> interpolation -> imputed flag.

    All of it is one flow over one scan, and the profile's counters travel with it: equal rows are
    counted first (partial counts before the shuffle), then summed and reduced to the kept row per
    key, then the entity windows run, and a final aggregate adds the counters up. Rows with null
    keys or another dimension stay in the flow as groups without a kept row.
    """
    df = standardize_columns(raw)
    keys = [ds.entity, ds.period]
    require_columns(df, keys + [ds.metric] + ([ds.entity_name] if ds.entity_name else []), ds.name)
    if ds.defaults:
        df = with_default_dims(df, dict(ds.defaults))
    order = [c for c in (ds.id_col, ds.order_col) if c and c in df.columns]
    if not order:
        raise ValueError(f"{ds.name}: an id column or an ingest ordinal must order repeated keys")
    keep = list(dict.fromkeys([*ds.dims, *keys, *([ds.entity_name] if ds.entity_name else []),
                               *([ds.id_col] if ds.id_col and ds.id_col in df.columns else []),
                               *[c for c in ds.extra_cols if c in df.columns], ds.metric]))
    ordinal = [c for c in order if c not in keep]
    df = df.select(*keep, *ordinal)
    dtypes = dict((f.name, f.dataType) for f in df.schema.fields)

    defaults = dict(ds.defaults)
    typed_cols = {
        **{c: typed_key(c, dtypes[c]) for c in ds.int_cols if c in dtypes},
        **{c: (F.coalesce(normalize_name(c), F.lit(defaults[c])) if c in defaults else normalize_name(c))
           for c in ds.name_cols if c in dtypes},
        ds.entity: typed_key(ds.entity, dtypes[ds.entity]),
        ds.period: typed_key(ds.period, dtypes[ds.period]),
        ds.metric: coerce_numeric(ds.metric, dtypes[ds.metric]),
        **({ds.entity_name: normalize_name(ds.entity_name)} if ds.entity_name else {}),
    }
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in keep])
    typed = df.select(*[typed_cols.get(c, F.col(c)).alias(c) for c in keep], *ordinal, nulls.alias("__nulls"))

    # 1. equal rows, 2. keys
    counted = typed.groupBy(*keep).agg(F.count(F.lit(1)).alias("__c"), F.sum("__nulls").alias("__nulls"), *[F.max(c).alias(c) for c in ordinal])
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    usable = has_key
    if ds.dim_filter:
        name, value = ds.dim_filter
        usable = usable & (F.col(name).isNull() | (F.col(name) == F.lit(value)))
    rest = [c for c in keep if c not in keys]
    grouped = counted.withColumn("__ok", usable).groupBy(*keys).agg(
        F.sum("__c").alias("__rows"), F.sum("__nulls").alias("__nulls"), F.sum(F.when(F.col("__ok"), F.col("__c")).otherwise(0)).alias("__n"),
        F.sum(F.when(F.col("__ok"), F.col("__c") - 1).otherwise(0)).alias("__again"),
        last_row(rest + ordinal, order, F.col("__ok")).alias("__row"))
    flow = grouped.select(*keys, "__rows", "__nulls", "__n", "__again", (F.col("__n") > 0).alias("__kept"),
                          *[F.col(f"__row.{c}").alias(c) for c in rest])

    # 3. windows over the kept rows of an entity (the others form groups of their own)
    flag = f"{ds.metric}_was_imputed"
    flow = flow.withColumn("__zero", F.coalesce(F.col("__kept") & (F.col(ds.metric) == 0), F.lit(False)) & F.lit(ds.zero_is_missing))
    if ds.zero_is_missing:
        flow = zero_to_missing(flow, ds.metric)
    flow = flow.withColumn(flag, F.col(ds.metric).isNull())
    # the raw column bounds the periods of the flow, and is one column's scan
    segment, tasks = SG.extent(df.select(typed_cols[ds.period].alias(ds.period)), ds.period, ds.segment_width, ds.task_rows)
    flow = interpolate_linear(flow, [ds.entity, "__kept"], [ds.period], ds.metric, segment=segment, tasks=tasks)
    flow = flow.withColumn(flag, F.col(flag) & F.col(ds.metric).isNotNull())

    out_cols = [c for c in [*ds.dims, *keys, *([ds.entity_name] if ds.entity_name else []), ds.metric, flag] if c in flow.columns]
    cleaned = flow.where("__kept").select(*dict.fromkeys(out_cols))
    add = lambda c: F.coalesce(F.sum(c), F.lit(0))
    kept = F.col("__kept")
    nulls_after = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in [*keep, flag]])
    profile = flow.agg(
        add(F.col("__rows")).alias("rows_raw"), F.count_if(kept).alias("rows_clean"), add(F.col("__nulls")).alias("missing_values_before"),
        add(F.when(kept, nulls_after)).alias("missing_values_after"),
        F.count_if(kept & (F.col(flag) | F.col(ds.metric).isNull())).alias("missing_metric_before_impute"),
        F.count_if(kept & F.col(flag)).alias("imputed_values"), F.count_if(F.col("__zero")).alias("invalid_zero_values"),
        add(F.when(has_key, 0).otherwise(F.col("__rows"))).alias("rows_dropped_missing_keys"),
        add(F.when(F.col("__n") > 1, F.col("__n")).otherwise(0)).alias("duplicate_key_rows"), add(F.col("__again")).alias("exact_duplicate_rows"))
    profile = profile.select(F.lit(ds.name).alias("logical_name"), F.lit(ds.metric).alias("metric"),
                             *[F.col(c).cast("bigint").alias(c) for c in PROFILE_COUNTERS])
    return cleaned, profile


PROFILE_COUNTERS = (
    "rows_raw", "rows_clean", "missing_values_before", "missing_values_after",
    "missing_metric_before_impute", "imputed_values", "invalid_zero_values",
    "rows_dropped_missing_keys", "duplicate_key_rows", "exact_duplicate_rows",
)


def missing_by_column(df: DataFrame, top: int = 20) -> DataFrame:
    """Null-cell count per column, descending, top ``top`` (a top-k report)."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    long = counts.unpivot([], list(df.columns), "column", "missing")
    return long.orderBy(F.col("missing").desc(), F.col("column")).limit(top)


def default_province(df: DataFrame) -> DataFrame:
    """Reference default dimensions (province code / name) when absent."""
    return with_default_dims(df, {"kode_provinsi": S.DEFAULT_PROVINCE_CODE,
                                  "nama_provinsi": S.DEFAULT_PROVINCE_NAME})
