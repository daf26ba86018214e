"""Integration queries: N-way outer join (faithful and one-shuffle forms), dimension
resolution, dimension join, period filter, missing-cell report."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import clean as C
from kestrel.operators import joins as J
from kestrel.operators import panel as P
from kestrel.plans.catalog import query
from kestrel.plans.output import canonical, r
from kestrel.plans.q_clean import SOURCES, clean_sql, cleaned
from kestrel.plans.testdata import PANEL_CTE, SMALL_SPEC, small_panel, table

KEYS = ["l_orderkey", "l_linenumber"]


def metric_frames(spark, sf_dir):
    frames = []
    for name, (ds, _) in SOURCES.items():
        out, _ = cleaned(spark, sf_dir, name)
        frames.append(out.select(*KEYS, ds.metric, f"{ds.metric}_was_imputed"))
    return frames


_CLEAN = ",\n".join(clean_sql(n) for n in SOURCES)
_METRICS = [ds.metric for ds, _ in SOURCES.values()]
_JOINED_SQL = f"""WITH {_CLEAN},
joined AS (
  SELECT * FROM (SELECT l_orderkey, l_linenumber, l_discount, l_discount_was_imputed FROM discount_lines_clean) a
  FULL OUTER JOIN (SELECT l_orderkey, l_linenumber, l_tax, l_tax_was_imputed FROM tax_lines_clean) b USING (l_orderkey, l_linenumber)
  FULL OUTER JOIN (SELECT l_orderkey, l_linenumber, l_quantity, l_quantity_was_imputed FROM quantity_lines_clean) c USING (l_orderkey, l_linenumber))"""
_JOINED_SELECT = ", ".join(["l_orderkey", "l_linenumber"] + [f"{r(m)} AS {m}, {m}_was_imputed" for m in _METRICS])


@query("panel_outer_join", f"{_JOINED_SQL}\nSELECT {_JOINED_SELECT} FROM joined")
def panel_outer_join(spark, sf_dir):
    """Three cleaned sources with different key sets, chained full outer joins."""
    return canonical(J.outer_join_all(metric_frames(spark, sf_dir), KEYS))


@query("panel_union_agg", f"{_JOINED_SQL}\nSELECT {_JOINED_SELECT} FROM joined")
def panel_union_agg(spark, sf_dir):
    """Same panel as ``panel_outer_join`` through one union + grouped aggregate (one shuffle)."""
    return canonical(J.union_aggregate(metric_frames(spark, sf_dir), KEYS))


@query("missing_by_column", f"""{_JOINED_SQL}
SELECT * FROM (
  UNPIVOT (SELECT {', '.join(f"count_if({c} IS NULL) AS {c}" for c in ['l_orderkey', 'l_linenumber'] + [x for m in _METRICS for x in (m, m + '_was_imputed')])} FROM joined)
  ON COLUMNS(*) INTO NAME "column" VALUE missing)
ORDER BY missing DESC, "column" LIMIT 20""")
def missing_by_column(spark, sf_dir):
    """Null cells per column of the integrated panel, descending (top-20 report)."""
    return C.missing_by_column(J.union_aggregate(metric_frames(spark, sf_dir), KEYS), 20)


_DIM_SOURCES_SQL = """dimsrc AS (
  SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS nkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS name,
         CAST(NULL AS VARCHAR) AS region_name, 0 AS src
  FROM customer
  UNION ALL
  SELECT DISTINCT CAST(n_nationkey AS BIGINT), n_name, r_name, 1 FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def dimension_sources(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    src0 = cust.select(F.col("c_nationkey").cast("bigint").alias("nkey"),
                       F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string"))
                       .otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("name"),
                       F.lit(None).cast("string").alias("region_name"))
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    src1 = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("nkey"), F.col("n_name").alias("name"),
        F.col("r_name").alias("region_name"))
    return [src0, src1]


@query("first_non_null_dims", f"""WITH {_DIM_SOURCES_SQL}
SELECT nkey,
  first(name ORDER BY name IS NULL, name, src, name) FILTER (WHERE name IS NOT NULL) AS name,
  first(region_name ORDER BY name IS NULL, name, src, region_name) FILTER (WHERE region_name IS NOT NULL) AS region_name
FROM dimsrc GROUP BY nkey""")
def first_non_null_dims(spark, sf_dir):
    """Per key, each dimension column's first non-null value across sources."""
    return J.resolve_dimensions(dimension_sources(spark, sf_dir), "nkey", "name", ["nkey", "name", "region_name"])


@query("dim_join", f"""WITH {clean_sql('quantity_lines')}
SELECT q.l_orderkey, q.l_linenumber, {r('q.l_quantity')} AS l_quantity, o.o_orderstatus, o.o_orderpriority
FROM quantity_lines_clean q LEFT JOIN orders o ON q.l_orderkey = o.o_orderkey""")
def dim_join(spark, sf_dir):
    """Many-to-one left join of cleaned line metrics to the order dimension."""
    out, _ = cleaned(spark, sf_dir, "quantity_lines")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                   "o_orderstatus", "o_orderpriority")
    joined = out.join(orders, "l_orderkey", "left")
    return canonical(joined.select("l_orderkey", "l_linenumber", "l_quantity", "o_orderstatus", "o_orderpriority"))


@query("period_filter", f"""WITH {PANEL_CTE}
SELECT entity, period, {r('m_ret')} AS m_ret FROM panel WHERE period BETWEEN 1996 AND 2000""")
def period_filter(spark, sf_dir):
    out = P.filter_period(small_panel(spark, sf_dir), SMALL_SPEC, 1996, 2000)
    return canonical(out.select("entity", "period", "m_ret"))


@query("union_dims", """
SELECT DISTINCT * FROM (
  SELECT CAST(c_nationkey AS BIGINT) AS nkey, 'customer' AS side FROM customer
  UNION ALL SELECT CAST(s_nationkey AS BIGINT), 'supplier' FROM supplier)""")
def union_dims(spark, sf_dir):
    """UNION ALL of dimension keys from two sources, then DISTINCT."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("bigint").alias("nkey"),
                                                F.lit("customer").alias("side"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("bigint").alias("nkey"),
                                                F.lit("supplier").alias("side"))
    return c.unionByName(s).distinct()
