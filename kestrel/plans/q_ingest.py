"""Ingest-side queries on the events table: JSON envelopes, flattening, content
fingerprints, duplicate skipping, repeated pages, manifest rows, retention, latest
event, catalog, CSV scan, newest landed file. A batch is one calendar day of events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kestrel.session import checkpoint_dir
from kestrel.sources import files as SF
from kestrel.sources import ingest as I
from kestrel.sources import merkle as MK
from kestrel.sources import records as R
from kestrel.plans.catalog import query
from kestrel.plans.output import canonical
from kestrel.plans.testdata import table

RECORD_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _envelope():
    p = F.col("props")
    t = F.col("event_type")
    return (F.when(t == "view", F.concat(F.lit('{"data": ['), p, F.lit(", "), p, F.lit("]}")))
            .when(t == "click", F.concat(F.lit('{"data": '), p, F.lit("}")))
            .when(t == "signup", F.concat(F.lit("["), p, F.lit(", 7]")))
            .when(t == "error", F.concat(F.lit('{"openapi": "3.0", "paths": {"/x": '), p, F.lit("}}")))
            .otherwise(F.concat(F.lit('{"meta": {"n": 1}, "note": "x", "rows": ['), p, F.lit("]}"))))


@query("json_records", """
SELECT event_id, unnest(range(1, n + 1)) AS record_no, k FROM (
  SELECT event_id, CASE event_type WHEN 'view' THEN 2 WHEN 'error' THEN 0 ELSE 1 END AS n,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) x""")
def json_records(spark, sf_dir):
    """Every event's props wrapped in one of five envelope shapes, records extracted back."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    recs = R.extract_records(ev.withColumn("payload", _envelope()), "payload", ["event_id"])
    return canonical(R.type_records(recs, "k INT"))


@query("flatten_struct", """
SELECT event_id, event_type AS "meta.event_type", round_even(CAST(value AS DOUBLE) * 10000e0, 0) / 10000e0 AS "meta.detail.value",
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS "meta.detail.k" FROM events""")
def flatten_struct(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    nested = ev.select("event_id", F.struct(
        "event_type", F.struct("value", F.from_json("props", "k INT")["k"].alias("k")).alias("detail")).alias("meta"))
    return canonical(R.flatten(nested))


def _batches(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("batch_day", F.dayofmonth("ts").cast("bigint"))
    return ev, MK.ordered_checksums(ev, ["batch_day"], "event_id", RECORD_COLS)


#: The same tree in SQL: level by level, a node's children joined as place:digest.
CHECKSUM_SQL = """n0 AS (SELECT CAST(day(ts) AS BIGINT) AS batch_day, CAST(event_id AS BIGINT) AS place, 1 AS n,
  sha256('{"event_id":' || event_id || ',"event_type":' || to_json(event_type) || ',"props":' || to_json(props)
         || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '","user_id":' || user_id || ',"value":' || CAST(value AS VARCHAR) || '}') AS digest FROM events),
""" + ",\n".join(f"""n{i + 1} AS (SELECT batch_day, place // {MK.FAN} AS place, sum(n) AS n,
  sha256(string_agg((place % {MK.FAN}) || ':' || digest, ';' ORDER BY place)) AS digest FROM n{i} GROUP BY 1, 2)""" for i in range(MK.HEIGHT)) + f""",
sums AS (SELECT batch_day, CAST(n AS BIGINT) AS n_records, sha256(n || ':' || digest) AS checksum FROM n{MK.HEIGHT})"""


@query("content_checksum", f"WITH {CHECKSUM_SQL} SELECT * FROM sums")
def content_checksum(spark, sf_dir):
    """Ordered sha256 digest of each day's records (Merkle tree over event ids)."""
    return _batches(spark, sf_dir)[1]


def _manifest(batches):
    # prior runs: the first half of the month was ingested before; odd days had failed
    prior = batches.where(F.col("batch_day") <= 15)
    return prior.select("checksum", F.when(F.col("batch_day") % 2 == 0, F.lit(I.SUCCESS))
                        .otherwise(F.lit(I.FAILED)).alias("status"))


@query("ingest_dedup", """
SELECT CAST(day(ts) AS BIGINT) AS batch_day, count(*) AS n_records,
       CASE WHEN day(ts) <= 15 AND day(ts) % 2 = 0 THEN 'skipped' ELSE 'success' END AS status,
       CASE WHEN day(ts) <= 15 AND day(ts) % 2 = 0 THEN 'duplicate_checksum' ELSE '' END AS notes
FROM events GROUP BY ALL""")
def ingest_dedup(spark, sf_dir):
    """Re-ingest of all day batches against a manifest of earlier runs: identical content
    that succeeded before is skipped."""
    _, batches = _batches(spark, sf_dir)
    return I.ingest_decisions(batches, _manifest(batches)).select("batch_day", "n_records", "status", "notes")


@query("repeated_pages", """
WITH e AS (SELECT *, CAST(day(ts) AS BIGINT) AS batch_day, 2 * (user_id % 10) AS page FROM events
           UNION ALL SELECT *, CAST(day(ts) AS BIGINT), 2 * (user_id % 10) + 1 FROM events WHERE day(ts) % 2 = 0),
p AS (SELECT batch_day, page, count(*) AS n_records,
             string_agg(CAST(event_id AS VARCHAR) || '|' || CAST(ts AS VARCHAR) || '|' || CAST(user_id AS VARCHAR)
                        || '|' || event_type || '|' || CAST(value AS VARCHAR) || '|' || props, '#'
                        ORDER BY event_id, ts, user_id, event_type, value, props) AS content
      FROM e GROUP BY 1, 2)
SELECT batch_day, CAST(page AS BIGINT) AS page, n_records,
       coalesce(content = lag(content) OVER (PARTITION BY batch_day ORDER BY page), false) AS repeated
FROM p""")
def repeated_pages(spark, sf_dir):
    """Pages of each day batch (by user_id mod 10; on even days every page comes twice), flagged when a
    page's records equal the previous page's (compared by content fingerprint)."""
    day, page = F.dayofmonth("ts").cast("bigint"), (F.col("user_id") % 10).cast("bigint")
    ev = table(spark, sf_dir, "events").withColumn("batch_day", day).withColumn(
        "page", F.explode(F.when(day % 2 == 0, F.array(2 * page, 2 * page + 1)).otherwise(F.array(2 * page))))
    sig = I.page_signatures(ev, ["batch_day"], "page", RECORD_COLS)
    return sig.select("batch_day", "page", "n_records", "repeated")


@query("run_manifest", f"""WITH {CHECKSUM_SQL}
SELECT '2024-01-31T00:00:00.000000Z' AS ingest_time, 'events' AS logical_name, 'events_day_' || batch_day || '.parquet' AS stored_filename,
       'events.parquet' AS source_url, checksum, CASE WHEN batch_day <= 15 AND batch_day % 2 = 0 THEN 'skipped' ELSE 'success' END AS status,
       CASE WHEN batch_day <= 15 AND batch_day % 2 = 0 THEN 'duplicate_checksum' ELSE '' END AS notes FROM sums""")
def run_manifest(spark, sf_dir):
    """Manifest rows an ingest run appends (one per batch, success or skipped); the ingest time is a
    parameter, here the last event's."""
    _, batches = _batches(spark, sf_dir)
    dec = I.ingest_decisions(batches, _manifest(batches)).withColumn("name", F.lit("events"))
    return I.manifest_rows(dec, "name", F.concat(F.lit("events_day_"), F.col("batch_day").cast("string"), F.lit(".parquet")),
                           F.lit("events.parquet"), F.lit("2024-01-31 00:00:00").cast("timestamp"))


@query("run_manifest_status", """
SELECT '2024-01-31T00:00:00.000000Z' AS ingest_time, 'events' AS logical_name, 'events_day_' || CAST(day(ts) AS VARCHAR) || '.parquet' AS stored_filename,
       'events.parquet' AS source_url, CASE WHEN day(ts) <= 15 AND day(ts) % 2 = 0 THEN 'skipped' ELSE 'success' END AS status,
       CASE WHEN day(ts) <= 15 AND day(ts) % 2 = 0 THEN 'duplicate_checksum' ELSE '' END AS notes
FROM events GROUP BY day(ts)""")
def run_manifest_status(spark, sf_dir):
    """The same rows without the checksum."""
    return run_manifest(spark, sf_dir).drop("checksum")


@query("retention_plan", """
SELECT event_type, version, dense_rank() OVER (PARTITION BY event_type ORDER BY version DESC) AS version_rank,
       dense_rank() OVER (PARTITION BY event_type ORDER BY version DESC) <= 5 AS keep
FROM (SELECT DISTINCT event_type, strftime(date_trunc('day', ts), '%Y%m%dT%H%M%SZ') AS version FROM events) v""")
def retention_plan(spark, sf_dir):
    """Keep the newest five daily versions per event type."""
    ev = table(spark, sf_dir, "events").select("event_type", SF.version_stamp(F.date_trunc("day", "ts")).alias("version"))
    return canonical(I.retention_plan(ev, "event_type", "version", 5))


@query("latest_event", """
SELECT event_type, event_id, user_id, round_even(CAST(value AS DOUBLE) * 10000e0, 0) / 10000e0 AS value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1""")
def latest_event(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_type", "event_id", "ts", "user_id", "value", "props")
    return canonical(I.latest_per_key(ev, "event_type", "ts", "event_id").drop("ts"))


@query("event_status_counts", """
SELECT event_type, CAST(day(ts) AS BIGINT) AS batch_day, count(*) AS n_events FROM events GROUP BY ALL""")
def event_status_counts(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.groupBy("event_type", F.dayofmonth("ts").cast("bigint").alias("batch_day")).agg(
        F.count(F.lit(1)).alias("n_events"))


@query("source_catalog", """
SELECT 'orders' AS source, count(*) AS rows, CAST(6 AS BIGINT) AS n_columns, CAST(min(year(o_orderdate)) AS BIGINT) AS year_min,
       CAST(max(year(o_orderdate)) AS BIGINT) AS year_max, 'usable_columns' AS kind FROM orders
UNION ALL SELECT 'lineitem', count(*), 11, min(year(l_shipdate)), max(year(l_shipdate)), 'usable_columns' FROM lineitem
UNION ALL SELECT 'events', count(*), 6, min(year(ts)), max(year(ts)), 'usable_columns' FROM events
UNION ALL SELECT 'customer', count(*), 5, NULL, NULL, 'not_statistical_records' FROM customer""")
def source_catalog(spark, sf_dir):
    """Per source: rows, columns, first and last year (one aggregate per source)."""
    parts = [I.source_summary("orders", table(spark, sf_dir, "orders"), "o_orderdate"),
             I.source_summary("lineitem", table(spark, sf_dir, "lineitem"), "l_shipdate"),
             I.source_summary("events", table(spark, sf_dir, "events"), "ts", ["event_id", "ts", "value"]),
             I.source_summary("customer", table(spark, sf_dir, "customer"), None, ["c_custkey", "year"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("scan_csv", """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       round_even(CAST(c_acctbal AS DOUBLE) * 10000e0, 0) / 10000e0 AS c_acctbal, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def scan_csv(spark, sf_dir):
    """Customers landed as header CSV (with 'N/A' placeholders), scanned back as text and typed."""
    cust = table(spark, sf_dir, "customer")
    landed = cust.withColumn("c_mktsegment", F.when(F.col("c_mktsegment") == "BUILDING", F.lit("N/A"))
                             .otherwise(F.col("c_mktsegment")))
    path = f"{checkpoint_dir(spark).rstrip('/')}/landing/customer-{uuid.uuid4().hex}"
    landed.write.option("header", True).csv(path)
    raw = SF.scan_csv(spark, path)
    return canonical(raw.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
                                F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
                                F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment"))
