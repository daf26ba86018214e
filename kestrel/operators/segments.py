"""Ordered scans over an entity's rows that don't need the entity in one task.

A window over one entity runs in one task, so an entity that holds a third of all rows makes that task
as long as the corpus. Here an entity is cut into segments of its order column, ``width`` order
values each: rows with unique (entity, order) and an integer order have at most ``width`` rows a segment.

1. Inside segments: ordinary windows, partitioned by (entity, segment).
2. Across segments: a segment is summed up in one small row (its size, its first and last known
   value, its last rows), and a window over these rows, a few per entity, gives every segment what comes
   before and after it: the carry.
3. Both are put together row by row, without another window.

Whether any of this is needed is known from the smallest and largest order value alone
(:func:`segment_of`): within one segment the plain windows are used, and the plan is the plain one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

WIDTH = 1 << 20  # order values of a segment
TASK_ROWS = 1 << 18  # rows of one task of the windows, however well they compress


def segment_of(df: DataFrame, order: str, width: int = WIDTH) -> Column | None:
    """The segment number of a row, or None where all rows lie in one segment (or the order is no
    integer, whose values say nothing about the number of rows between them)."""
    return extent(df, order, width)[0] if _is_integer(df, order) else None


def extent(df: DataFrame, order: str, width: int = WIDTH, task_rows: int = TASK_ROWS) -> tuple[Column | None, int]:
    """The segment number as in :func:`segment_of`, and the tasks that hold all rows at about
    ``task_rows`` each. Partitions sized by their bytes alone hold the more rows the better these compress."""
    integer = _is_integer(df, order)
    ends = df.agg(F.count(F.lit(1)).alias("rows"), *([F.min(order).alias("low"), F.max(order).alias("high")] if integer else [])).first()  # one row
    tasks = -(-ends["rows"] // task_rows) or 1
    if not integer or ends["low"] is None or ends["low"] // width == ends["high"] // width:
        return None, tasks
    # floored, so that negative orders keep their sequence; null orders come first
    return F.coalesce(F.floor(F.col(order) / F.lit(width)).cast("bigint"), F.lit(ends["low"] // width - 1)), tasks


def _is_integer(df: DataFrame, order: str) -> bool:
    return isinstance(df.schema[order].dataType, (ByteType, ShortType, IntegerType, LongType))


def _windows(groups: list[str], order: list[str]):
    inside = Window.partitionBy(*groups, "__seg").orderBy(*order)
    across = Window.partitionBy(*groups).orderBy("__seg")
    return inside, across.rowsBetween(Window.unboundedPreceding, -1), across.rowsBetween(1, Window.unboundedFollowing)


def _with_carry(rows: DataFrame, carry: DataFrame, groups: list[str]) -> DataFrame:
    """rows and their segment's carry. Groups are never null-joined away."""
    keys = [F.col(f"r.{g}").eqNullSafe(F.col(f"k.{g}")) for g in [*groups, "__seg"]]
    on = keys[0]
    for k in keys[1:]:
        on = on & k
    extra = [c for c in carry.columns if c not in groups and c != "__seg"]
    return rows.alias("r").join(carry.alias("k"), on, "left").select("r.*", *[f"k.{c}" for c in extra])


def interpolate(df: DataFrame, groups: list[str], order: list[str], value: str, out: str, segment: Column, tasks: int | None = None) -> DataFrame:
    """Interior linear interpolation by row position, over segments (same result as the plain windows)."""
    rows = df.withColumn("__seg", segment)
    rows = rows.repartition(tasks, *groups, "__seg") if tasks else rows
    inside, before, after = _windows(groups, order)
    backward = Window.partitionBy(*groups, "__seg").orderBy(*[F.col(c).desc() for c in order])  # growing frames only
    rows = rows.withColumn("__pos", F.row_number().over(inside))
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("__pos").alias("i"), F.col(value).cast("double").alias("v")))
    sums = rows.groupBy(*groups, "__seg").agg(F.count(F.lit(1)).alias("n"), F.min_by(known, F.when(known.isNotNull(), F.col("__pos"))).alias("first"),
                                              F.max_by(known, F.when(known.isNotNull(), F.col("__pos"))).alias("last"))
    sums = sums.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = lambda c: F.when(F.col(c).isNotNull(), F.struct((F.col("base") + F.col(f"{c}.i")).alias("i"), F.col(f"{c}.v").alias("v")))
    sums = sums.withColumns({"first": placed("first"), "last": placed("last")})
    carry = sums.select(*groups, "__seg", F.col("base").alias("__base"), F.last("last", ignorenulls=True).over(before).alias("__left"),
                        F.first("first", ignorenulls=True).over(after).alias("__right"))
    rows = rows.withColumns({
        "__p": F.last(known, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)),
        "__n": F.last(known, ignorenulls=True).over(backward.rowsBetween(Window.unboundedPreceding, -1))})
    rows = _with_carry(rows, carry, groups)
    here = lambda c: F.struct((F.col("__base") + F.col(f"{c}.i")).alias("i"), F.col(f"{c}.v").alias("v"))
    rows = rows.withColumns({"__p": F.when(F.col("__p").isNotNull(), here("__p")).otherwise(F.col("__left")),
                             "__n": F.when(F.col("__n").isNotNull(), here("__n")).otherwise(F.col("__right")),
                             "__pos": F.col("__base") + F.col("__pos")})
    share = (F.col("__pos") - F.col("__p.i")) / (F.col("__n.i") - F.col("__p.i"))
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(
        F.col("__p").isNotNull() & F.col("__n").isNotNull(), F.col("__p.v") + (F.col("__n.v") - F.col("__p.v")) * share)
    return rows.withColumn(out, filled).drop("__seg", "__pos", "__base", "__left", "__right", "__p", "__n")


def previous_rows(df: DataFrame, groups: list[str], order: list[str], columns: list[str], n: int, segment: Column, out: str = "__rows") -> DataFrame:
    """df with ``out``: the row's own and up to ``n - 1`` previous rows of its entity, oldest first, as
    structs of ``columns``. Enough for a lag and for any mean over the last n rows."""
    rows = df.withColumn("__seg", segment)
    inside, _, _ = _windows(groups, order)
    item = F.struct(*columns)
    rows = rows.withColumns({"__last": F.collect_list(item).over(inside.rowsBetween(-(n - 1), Window.currentRow)),
                             "__left_over": F.row_number().over(Window.partitionBy(*groups, "__seg").orderBy(*[F.col(c).desc() for c in order]))})
    # the last row of a segment has its last n - 1 rows with it
    tails = rows.where("__left_over = 1").select(*groups, "__seg", F.slice(F.reverse("__last"), 1, n - 1).alias("tail") if n > 1 else F.array().alias("tail"))
    earlier = Window.partitionBy(*groups).orderBy(F.col("__seg").desc()).rowsBetween(1, max(n - 1, 1))  # each has a row at least
    carry = tails.select(*groups, "__seg", F.flatten(F.collect_list("tail").over(earlier)).alias("__before"))  # newest first
    rows = _with_carry(rows, carry, groups)
    missing = F.lit(n) - F.size("__last")
    older = F.when((missing > 0) & (F.size("__before") > 0), F.reverse(F.slice("__before", F.lit(1), F.greatest(missing, F.lit(1)))))
    return rows.withColumn(out, F.when(older.isNotNull(), F.concat(older, F.col("__last"))).otherwise(F.col("__last"))) \
        .drop("__seg", "__last", "__left_over", "__before")
