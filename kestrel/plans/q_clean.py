"""Scrub-stage queries over the line items: names, numbers, keys, dedup, zeros, interpolation,
quality profile. Line items are a natural dirty source: (order, line number) repeats,
two-decimal rates contain zeros that act as missing-value placeholders."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import text as T
from kestrel.operators import clean as C
from kestrel.plans.catalog import query
from kestrel.plans.output import canonical, r
from kestrel.plans.sqltext import clean_ctes
from kestrel.plans.testdata import table

# ---------------------------------------------------------------- metric sources
DS_DISC = C.DatasetSpec("discount_lines", metric="l_discount", entity="l_orderkey",
                        period="l_linenumber", id_col="l_partkey")
DS_TAX = C.DatasetSpec("tax_lines", metric="l_tax", entity="l_orderkey",
                       period="l_linenumber", id_col="l_partkey")
DS_QTY = C.DatasetSpec("quantity_lines", metric="l_quantity", entity="l_orderkey",
                       period="l_linenumber", id_col="l_partkey")

SOURCES = {  # dataset → (spec, row filter on line items); every text here serves Spark and the oracle
    DS_DISC.name: (DS_DISC, "l_returnflag <> 'N'"),
    DS_TAX.name: (DS_TAX, "l_linestatus = 'O'"),
    DS_QTY.name: (DS_QTY, "TRUE"),
}
# Dirt derived from the rows themselves: keys and metrics go missing, ids vanish, rows come twice.
DIRTY_KEY = "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_orderkey END"
DIRTY_ID = "CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_partkey END"
DIRTY_METRIC = "CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE {m} END"
TWICE = "l_suppkey % 13 = 0"


def raw_source(spark, sf_dir, name):
    ds, cond = SOURCES[name]
    return (table(spark, sf_dir, "lineitem").where(F.expr(cond))
            .select(F.expr(DIRTY_KEY).alias(ds.entity), ds.period, F.expr(DIRTY_ID).alias(ds.id_col), F.expr(DIRTY_METRIC.format(m=ds.metric)).alias(ds.metric),
                    F.explode(F.expr(f"CASE WHEN {TWICE} THEN array(1, 2) ELSE array(1) END")).alias("copy")).drop("copy"))


def cleaned(spark, sf_dir, name):
    return C.clean_dataset(raw_source(spark, sf_dir, name), SOURCES[name][0])


def clean_sql(name: str) -> str:
    """CTE chain raw → dedup → keep-last → zero-null → interpolated, ending in ``{name}_clean``."""
    ds, cond = SOURCES[name]
    e, p, i, m = ds.entity, ds.period, ds.id_col, ds.metric
    cols = f"{DIRTY_KEY} AS {e}, {p}, {DIRTY_ID} AS {i}, {DIRTY_METRIC.format(m=m)} AS {m}"
    raw = f"SELECT {cols} FROM lineitem WHERE {cond} UNION ALL SELECT {cols} FROM lineitem WHERE ({cond}) AND {TWICE}"
    return clean_ctes(name, raw, e, p, i, m)


# ---------------------------------------------------------------- scalar functions
@query("snake_case_values", f"""
SELECT p_partkey,
  trim(regexp_replace(regexp_replace(lower(' ' || p_name || ' -- ' || p_brand || '/' || p_type || '! '),
       '[^0-9a-zA-Z]+', '_', 'g'), '_+', '_', 'g'), '_') AS name_key
FROM part""")
def snake_case_values(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    raw = F.concat(F.lit(" "), "p_name", F.lit(" -- "), "p_brand", F.lit("/"), "p_type", F.lit("! "))
    return part.select("p_partkey", T.snake_case_col(raw).alias("name_key"))


@query("normalize_name", """
SELECT c_custkey, upper(trim(regexp_replace('  ' || lower(replace(c_name, '#', '   #  ')) || ' ' || c_mktsegment || '  ',
       '\\s+', ' ', 'g'))) AS name_norm
FROM customer""")
def normalize_name(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    raw = F.concat(F.lit("  "), F.lower(F.replace("c_name", F.lit("#"), F.lit("   #  "))), F.lit(" "),
                   "c_mktsegment", F.lit("  "))
    return cust.select("c_custkey", T.normalize_name(raw).alias("name_norm"))


def _formatted_price_spark():
    k = F.col("o_orderkey") % 5
    grouped = F.format_number("o_totalprice", 2)
    return (F.when(k == 0, F.concat(F.lit("Rp "), F.translate(grouped, ",.", ".,")))
            .when(k == 1, grouped)
            .when(k == 2, F.concat((F.col("o_custkey") % 100).cast("string"), F.lit(","),
                                   (F.col("o_orderkey") % 10).cast("string"), F.lit("%")))
            .when(k == 3, F.lit("-"))
            .otherwise(F.lit("null")))


_FORMATTED_PRICE_SQL = """CASE o_orderkey % 5
  WHEN 0 THEN 'Rp ' || translate(format('{:,.2f}', o_totalprice), ',.', '.,')
  WHEN 1 THEN format('{:,.2f}', o_totalprice)
  WHEN 2 THEN CAST(o_custkey % 100 AS VARCHAR) || ',' || CAST(o_orderkey % 10 AS VARCHAR) || '%'
  WHEN 3 THEN '-' ELSE 'null' END"""


@query("coerce_numeric", f"""
WITH s AS (SELECT o_orderkey, o_totalprice, {_FORMATTED_PRICE_SQL} AS raw FROM orders)
SELECT o_orderkey, raw, CASE o_orderkey % 5
   WHEN 0 THEN o_totalprice WHEN 1 THEN o_totalprice
   WHEN 2 THEN CAST(split_part(replace(raw, '%', ''), ',', 1) || '.' || split_part(replace(raw, '%', ''), ',', 2) AS DOUBLE)
   ELSE NULL END AS value
FROM s""")
def coerce_numeric(spark, sf_dir):
    """Locale-formatted strings derived from every order price, parsed back to numbers."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    s = o.select("o_orderkey", _formatted_price_spark().alias("raw"))
    return canonical(s.select("o_orderkey", "raw", T.coerce_numeric("raw").alias("value")))


@query("default_dims", """
SELECT s_suppkey, CAST(s_nationkey AS BIGINT) AS s_nationkey, CAST(32 AS BIGINT) AS kode_provinsi, 'JAWA BARAT' AS nama_provinsi FROM supplier""")
def default_dims(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return canonical(C.default_province(sup))


@query("typed_keys", """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(l_partkey AS BIGINT) AS l_partkey FROM lineitem""")
def typed_keys(spark, sf_dir):
    """Keys arriving as text/double are typed to bigint; a fractional key raises."""
    li = table(spark, sf_dir, "lineitem")
    as_text = li.select(F.col("l_orderkey").cast("string").alias("k1"),
                        (F.col("l_linenumber").cast("double")).alias("k2"),
                        F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" ")).alias("k3"))
    return as_text.select(C.typed_key("k1").alias("l_orderkey"),
                          C.typed_key("k2", as_text.schema["k2"].dataType).alias("l_linenumber"),
                          C.typed_key("k3").alias("l_partkey"))


@query("drop_null_keys", f"""
WITH s AS (SELECT o_orderkey, {_FORMATTED_PRICE_SQL} AS raw FROM orders),
v AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (3, 4) THEN NULL ELSE o_orderkey END AS k FROM s)
SELECT count(*) AS rows_before, count(k) AS rows_after, count(*) - count(k) AS rows_dropped_missing_keys FROM v""")
def drop_null_keys(spark, sf_dir):
    """Keys parsed from the formatted strings: missing tokens become null keys and are dropped."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    s = o.select("o_orderkey", _formatted_price_spark().alias("raw"))
    v = s.select("o_orderkey", F.when(T.coerce_numeric("raw").isNull(), F.lit(None)).otherwise(F.col("o_orderkey")).alias("k"))
    kept = C.drop_null_keys(v, ["k"])
    before = v.agg(F.count(F.lit(1)).alias("rows_before"), C.count_null_keys(["k"]).alias("rows_dropped_missing_keys"))
    after = kept.agg(F.count(F.lit(1)).alias("rows_after"))
    return C.combine_single_rows([before, after])


@query("dim_filter", """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IS NULL OR c_mktsegment = 'BUILDING'""")
def dim_filter(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return C.dimension_filter(cust, "c_mktsegment", "BUILDING")


@query("zero_to_missing", """
SELECT count(*) AS rows, count_if(l_discount = 0) AS invalid_zero_values,
       count(NULLIF(l_discount, 0)) AS non_missing_after,
       count_if(l_tax = 0) AS invalid_zero_tax, count(NULLIF(l_tax, 0)) AS non_missing_tax_after
FROM lineitem""")
def zero_to_missing(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_discount", "l_tax")
    zeroed = C.zero_to_missing(C.zero_to_missing(li.withColumns(
        {"d0": F.col("l_discount"), "t0": F.col("l_tax")}), "l_discount"), "l_tax")
    return zeroed.agg(F.count(F.lit(1)).alias("rows"),
                      C.count_zeros("d0").alias("invalid_zero_values"),
                      F.count("l_discount").alias("non_missing_after"),
                      C.count_zeros("t0").alias("invalid_zero_tax"),
                      F.count("l_tax").alias("non_missing_tax_after"))


@query("dedup_keep_last", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
     l_partkey IS NULL DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
     l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) AS rn
  FROM (SELECT DISTINCT * FROM lineitem) d) t
WHERE rn = 1""")
def dedup_keep_last(spark, sf_dir):
    """Repeated (order, line) records: keep the last by part id (null id wins), rest as tie-break."""
    li = table(spark, sf_dir, "lineitem")
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    out = C.keep_last(li, ["l_orderkey", "l_linenumber"], order)  # identical rows share the key: no pass of their own
    return canonical(out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount"))


@query("exact_dedup", """
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT lang, source, text FROM documents) d) AS distinct_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, source, text FROM documents) d) AS exact_duplicate_rows
FROM documents""")
def exact_dedup(spark, sf_dir):
    """Exact duplicates among documents (whole texts compared), null equals null."""
    docs = table(spark, sf_dir, "documents").select("lang", "source", "text")
    stats = C.duplicate_stats(docs, ["lang", "source", "text"])
    distinct = C.exact_dedup(docs).agg(F.count(F.lit(1)).alias("distinct_rows"))
    both = C.combine_single_rows([stats.select("rows", "exact_duplicate_rows"), distinct])
    return both.select("rows", "distinct_rows", "exact_duplicate_rows")


@query("duplicate_key_profile", """
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicate_key_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_key_surplus,
       count(*) AS distinct_keys,
       (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem) x) FROM lineitem) AS exact_duplicate_rows,
       CAST(sum(n) AS BIGINT) AS rows
FROM g""")
def duplicate_key_profile(spark, sf_dir):
    return canonical(C.duplicate_stats(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query("interpolate_linear", f"""
WITH {clean_sql('discount_lines')}
SELECT l_orderkey, l_linenumber, {r('l_discount')} AS l_discount, l_discount_was_imputed FROM discount_lines_clean""")
def interpolate_linear(spark, sf_dir):
    """Zero discounts → missing, then interior linear fill along each order's lines."""
    out, _ = cleaned(spark, sf_dir, "discount_lines")
    return canonical(out)


def _profile_sql(name: str) -> str:
    ds, _ = SOURCES[name]
    e, p, i, m = ds.entity, ds.period, ds.id_col, ds.metric
    return f"""SELECT '{name}' AS logical_name, '{m}' AS metric,
  (SELECT count(*) FROM {name}_raw) AS rows_raw,
  (SELECT count(*) FROM {name}_clean) AS rows_clean,
  (SELECT count_if({e} IS NULL) + count_if({p} IS NULL) + count_if({i} IS NULL) + count_if({m} IS NULL) FROM {name}_raw) AS missing_values_before,
  (SELECT count_if({i} IS NULL) + count_if({m} IS NULL) FROM {name}_clean) AS missing_values_after,
  (SELECT count_if({m}_zeroed IS NULL) FROM {name}_clean) AS missing_metric_before_impute,
  (SELECT count_if({m}_was_imputed) FROM {name}_clean) AS imputed_values,
  (SELECT count_if({m}_orig = 0) FROM {name}_clean) AS invalid_zero_values,
  (SELECT count_if({e} IS NULL OR {p} IS NULL) FROM {name}_raw) AS rows_dropped_missing_keys,
  (SELECT CAST(coalesce(sum(CASE WHEN n > 1 THEN n ELSE 0 END), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {name}_raw WHERE {e} IS NOT NULL GROUP BY {e}, {p}) g) AS duplicate_key_rows,
  (SELECT count_if({e} IS NOT NULL) FROM {name}_raw) - (SELECT count(*) FROM {name}_dist) AS exact_duplicate_rows"""


@query("quality_profile", "WITH " + ",\n".join(clean_sql(n) for n in SOURCES) + "\n"
       + "\nUNION ALL\n".join(_profile_sql(n) for n in SOURCES))
def quality_profile(spark, sf_dir):
    """Ten counters per metric source (computed before any period filter)."""
    profiles = [cleaned(spark, sf_dir, n)[1] for n in SOURCES]
    out = profiles[0]
    for p in profiles[1:]:
        out = out.unionByName(p)
    return out


_SOURCE_INFO = [(n, ds.metric, "parquet", "lineitem.parquet") for n, (ds, _) in SOURCES.items()]


@query("quality_summary", "WITH " + ",\n".join(clean_sql(n) for n in SOURCES) + ",\nprof AS (\n"
       + "\nUNION ALL\n".join(_profile_sql(n) for n in SOURCES) + "),\ninfo AS ("
       + " UNION ALL ".join(f"SELECT '{a}' AS logical_name, '{b}' AS metric, '{c}' AS source_mode, '{d}' AS source_file"
                            for a, b, c, d in _SOURCE_INFO)
       + ")\nSELECT prof.*, info.source_mode, info.source_file FROM prof LEFT JOIN info USING (logical_name, metric)")
def quality_summary(spark, sf_dir):
    """Quality profile joined (left, two keys) with where each source was read from."""
    profiles = [cleaned(spark, sf_dir, n)[1] for n in SOURCES]
    prof = profiles[0]
    for p in profiles[1:]:
        prof = prof.unionByName(p)
    info = spark.createDataFrame(_SOURCE_INFO, "logical_name string, metric string, source_mode string, source_file string")
    return prof.join(info, ["logical_name", "metric"], "left")
