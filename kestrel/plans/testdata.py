"""Mapping of the panel model onto the TPC-H-style test tables.

Small panel: entity = customer nation, period = order year, five metrics averaged over
line items. Large panel (bench): entity = customer, period = order month.

Build strategy (both panels): line items are pre-aggregated per order (partial
aggregation map-side; an order's lines are contiguous in the files), joined 1:1 with
orders on the same hash partitioning, pre-aggregated again per (customer, period), and
only then joined to the customer dimension. Every average is carried as (sum, count)
so the result equals the per-line-item average of a direct three-way join.

Money and rates carry two decimals, so sums are taken over exact integers (cents,
percent points) and every metric is one final division: the panel is bit-identical
whatever order the partial sums are combined in (and across engines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.numeric import round_half_even

from kestrel.spec import CONTEXT_ONLY, HIGH_IS_RISKY, LOW_IS_RISKY, MetricSpec, PanelSpec

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

METRICS = (
    MetricSpec("m_ctx", "Average order value", "currency", CONTEXT_ONLY, low=0.0, low_strict=True),
    MetricSpec("m_ret", "Returned line share", "percent", HIGH_IS_RISKY, low=0.0, high=100.0),
    MetricSpec("m_disc", "Average discount", "percent", HIGH_IS_RISKY, low=0.0),
    MetricSpec("m_qty", "Average quantity", "units", LOW_IS_RISKY, low=0.0, high=100.0),
    MetricSpec("m_tax", "Average tax", "percent", HIGH_IS_RISKY, low=0.0, high=100.0),
)
CLUSTER_FEATURES = ("m_ret", "m_disc", "m_qty", "m_tax")
CONTEXT_METRIC = "m_ctx"
DEV_METRIC = "m_qty"      # the low-is-risky "development" indicator used for archetypes
TYPE_PREFIX = "A"         # group names starting with this letter form the first type

SMALL_SPEC = PanelSpec(
    entity="entity", period="period", metrics=METRICS, entity_name="entity_name",
    dims=("entity", "entity_name", "group_name"), trend_metric="m_ret",
    expected_entities=25, period_start=1995, period_end=2001,
)
LARGE_SPEC = PanelSpec(
    entity="entity", period="period", metrics=METRICS, entity_name=None,
    dims=("entity",), trend_metric="m_ret", period_start=199501, period_end=200112,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table, listed anew at every call (files may have landed meanwhile)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hundredths(c: str):
    """Two-decimal value as an exact integer count of hundredths."""
    return round_half_even(F.col(c) * 100, 0).cast("bigint")


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with line-item sums (pre-aggregated before the join)."""
    li = table(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("s_ret"),
        F.sum(hundredths("l_discount")).alias("s_disc"),
        F.sum("l_quantity").alias("s_qty"),
        F.sum(hundredths("l_tax")).alias("s_tax"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)


_SUMS = ("n", "s_ctx", "s_ret", "s_disc", "s_qty", "s_tax")


def _sum_aggs() -> list:
    return [F.sum(c).alias(c) for c in _SUMS]


def _metrics_from_sums() -> list:
    n = F.col("n")
    return [
        (F.col("s_ctx").cast("double") / (n * 100)).alias("m_ctx"),
        ((F.col("s_ret") * 100).cast("double") / n).alias("m_ret"),
        (F.col("s_disc").cast("double") / n).alias("m_disc"),
        (F.col("s_qty") / n).alias("m_qty"),
        (F.col("s_tax").cast("double") / n).alias("m_tax"),
    ]


def customer_period_sums(spark: SparkSession, sf_dir: str, period: str = "year") -> DataFrame:
    facts = order_facts(spark, sf_dir)
    if period == "year":
        p = F.year("o_orderdate")
    else:
        p = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    return (facts.withColumn("s_ctx", hundredths("o_totalprice") * F.col("n"))
            .groupBy(F.col("o_custkey"), p.cast("bigint").alias("period"))
            .agg(*_sum_aggs()))


def small_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nation, year) panel with names; 25 nations x 7 years at most."""
    sums = customer_period_sums(spark, sf_dir, "year")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    by_nation = (sums.join(cust, sums.o_custkey == cust.c_custkey)
                 .groupBy(F.col("c_nationkey").cast("bigint").alias("entity"), "period")
                 .agg(*_sum_aggs()))
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    dims = (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("bigint").alias("entity"),
                    F.col("n_name").alias("entity_name"), F.col("r_name").alias("group_name")))
    # dims: 25 rows from two tiny files; the planner broadcasts them by file size.
    return by_nation.select("entity", "period", *_metrics_from_sums()).join(dims, "entity", "left")


def large_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer, month) panel: one row per customer-month with orders."""
    sums = customer_period_sums(spark, sf_dir, "month")
    return sums.select(F.col("o_custkey").cast("bigint").alias("entity"), "period", *_metrics_from_sums())


# --------------------------------------------------------------------------- SQL side
SMALL_PANEL_SQL = """
SELECT CAST(c_nationkey AS BIGINT) AS entity, CAST(year(o_orderdate) AS BIGINT) AS period,
       CAST(sum(CAST(round(o_totalprice*100) AS BIGINT)) AS DOUBLE) / (100*count(*)) AS m_ctx,
       CAST(100*sum(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS m_ret,
       CAST(sum(CAST(round(l_discount*100) AS BIGINT)) AS DOUBLE) / count(*) AS m_disc,
       sum(l_quantity) / count(*) AS m_qty,
       CAST(sum(CAST(round(l_tax*100) AS BIGINT)) AS DOUBLE) / count(*) AS m_tax
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
GROUP BY 1, 2
"""

SMALL_DIMS_SQL = """
SELECT CAST(n_nationkey AS BIGINT) AS entity, n_name AS entity_name, r_name AS group_name
FROM nation JOIN region ON n_regionkey=r_regionkey
"""

PANEL_CTE = f"""panel AS (
  SELECT b.*, d.entity_name, d.group_name
  FROM ({SMALL_PANEL_SQL}) b LEFT JOIN ({SMALL_DIMS_SQL}) d USING (entity)
)"""

LARGE_PANEL_SQL = """
SELECT CAST(o_custkey AS BIGINT) AS entity, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS period,
       CAST(sum(CAST(round(o_totalprice*100) AS BIGINT)) AS DOUBLE) / (100*count(*)) AS m_ctx,
       CAST(100*sum(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS m_ret,
       CAST(sum(CAST(round(l_discount*100) AS BIGINT)) AS DOUBLE) / count(*) AS m_disc,
       sum(l_quantity) / count(*) AS m_qty,
       CAST(sum(CAST(round(l_tax*100) AS BIGINT)) AS DOUBLE) / count(*) AS m_tax
FROM lineitem JOIN orders ON l_orderkey=o_orderkey
GROUP BY 1, 2
"""
LARGE_PANEL_CTE = f"panel AS ({LARGE_PANEL_SQL})"
