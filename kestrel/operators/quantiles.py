"""Exact linear-interpolated quantiles that never bring a whole column into one task.

Spark's exact ``percentile`` keeps a value -> count map of the group and merges it in a single
task. Here, at every size alike:

1. the columns are stacked into (column, value) pairs, equal pairs are counted (with partial
   counts before the shuffle), and the distinct pairs are range-partitioned and written once;
2. the partitions' totals (one row per column and partition) give the rank each starts at;
3. for every wanted rank only the partition that holds it is ordered, with running counts.

The values at ranks floor(r) and floor(r) + 1, r = (n - 1) p, are interpolated as numpy's default
('linear') method does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import cut_lineage


def exact_quantiles_multi(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Rows (col, prob_index, prob, value) for every column and probability. Null values are
    ignored; an all-null column gives no row."""
    stacked = F.array(*[F.struct(F.lit(c).alias("__col"), F.col(c).cast("double").alias("__x")) for c in cols])
    counted = (df.select(F.inline(stacked)).where(F.col("__x").isNotNull())
               .groupBy("__col", "__x").agg(F.count(F.lit(1)).alias("__c")))
    # written once, so that the totals and the look-up see the same partitions
    ranged = cut_lineage(counted.repartitionByRange("__col", "__x").withColumn("__part", F.spark_partition_id()))
    parts = ranged.groupBy("__col", "__part").agg(F.sum("__c").alias("__m"))
    before = Window.partitionBy("__col").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__from", F.coalesce(F.sum("__m").over(before), F.lit(0))) \
        .withColumn("__n", F.sum("__m").over(Window.partitionBy("__col")))
    wanted = F.array(*[F.struct(F.lit(i).alias("pi"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    targets = (parts.select("__col", "__part", "__m", "__from", "__n", F.inline(wanted))
               .withColumn("r", (F.col("__n") - 1) * F.col("p"))
               .withColumn("next", F.explode(F.array(F.lit(0), F.lit(1))))
               .withColumn("rank", F.least(F.floor("r") + F.col("next"), F.col("__n") - 1))
               .where((F.col("rank") >= F.col("__from")) & (F.col("rank") < F.col("__from") + F.col("__m"))))
    running = Window.partitionBy("__col", "pi", "next").orderBy("__x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # targets has two rows per column and probability
    ranked = ranged.join(F.broadcast(targets.drop("__m", "__n")), ["__col", "__part"]).withColumn("__upto", F.col("__from") + F.sum("__c").over(running))
    values = ranked.where(F.col("__upto") > F.col("rank")).groupBy("__col", "pi", "p", "r", "next").agg(F.min("__x").alias("v"))
    both = values.groupBy("__col", "pi", "p", "r").agg(F.max(F.when(F.col("next") == 0, F.col("v"))).alias("v0"),
                                                       F.max(F.when(F.col("next") == 1, F.col("v"))).alias("v1"))
    share = F.col("r") - F.floor("r")
    value = F.when(share == 0, F.col("v0")).otherwise(F.col("v0") + share * (F.col("v1") - F.col("v0")))
    return both.select(F.col("__col").alias("col"), F.col("pi").alias("prob_index"), F.col("p").alias("prob"), value.alias("value"))


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """One row per probability: (prob_index, prob, value)."""
    return exact_quantiles_multi(df, [col], probs).drop("col")


def quantile_row(df: DataFrame, col: str | list[str], probs: list[float], names: list[str]) -> DataFrame:
    """Quantiles pivoted into one row. For several columns ``names`` lists the output
    names column by column (len(cols) * len(probs) names)."""
    cols = [col] if isinstance(col, str) else list(col)
    q = exact_quantiles_multi(df, cols, probs)
    k = len(probs)
    return q.agg(*[F.max(F.when((F.col("col") == c) & (F.col("prob_index") == i), F.col("value"))).alias(names[ci * k + i])
                   for ci, c in enumerate(cols) for i in range(k)])
