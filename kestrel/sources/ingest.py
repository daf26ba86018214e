"""Idempotent ingest bookkeeping as DataFrame operations: content fingerprints, duplicate
skipping against a manifest, repeated-page guard, manifest rows, retention plan.

Fingerprint at scale: a batch's checksum must not require its records in one task, so it
is an order-insensitive multiset hash: every record's canonical JSON (keys sorted) is
hashed with xxhash64 and the batch keeps (count, sum of hashes as a 128-bit decimal,
xor of a second hash) — all combinable map-side — then sha256 of that summary. Equal
record multisets give equal checksums whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Status words and manifest columns.
SUCCESS, SKIPPED, FAILED = "success", "skipped", "failed"
MANIFEST_COLUMNS = ("ingest_time", "logical_name", "stored_filename", "source_url", "checksum", "status", "notes")


def canonical_json(cols: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in sorted(cols)]))


def record_hash(cols: list[str]) -> Column:
    return F.xxhash64(canonical_json(cols))


def batch_checksums(df: DataFrame, batch_cols: list[str], record_cols: list[str]) -> DataFrame:
    """Per batch: record count and sha256 content fingerprint (order-insensitive)."""
    h = record_hash(record_cols)
    h2 = F.hash(canonical_json(record_cols))
    agg = df.groupBy(*batch_cols).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.sum(h.cast("decimal(38,0)")).alias("__s"),
        F.bit_xor(h2).alias("__x"))
    summary = F.concat_ws(":", F.col("n_records").cast("string"), F.col("__s").cast("string"),
                          F.col("__x").cast("string"))
    return agg.select(*batch_cols, "n_records", F.sha2(summary, 256).alias("checksum"))


def ingest_decisions(batches: DataFrame, manifest: DataFrame) -> DataFrame:
    """Each incoming batch: ``skipped`` (same checksum already ingested successfully,
    note ``duplicate_checksum``) or ``success`` (new content)."""
    done = manifest.where(F.col("status") == SUCCESS).select("checksum").distinct()
    seen = batches.join(done, "checksum", "left_semi").withColumns(
        {"status": F.lit(SKIPPED), "notes": F.lit("duplicate_checksum")})
    new = batches.join(done, "checksum", "left_anti").withColumns(
        {"status": F.lit(SUCCESS), "notes": F.lit("")})
    return seen.unionByName(new)


def page_signatures(df: DataFrame, batch_cols: list[str], page_col: str, record_cols: list[str]) -> DataFrame:
    """Per (batch, page) fingerprint and a flag when a page repeats the previous page."""
    sig = batch_checksums(df, [*batch_cols, page_col], record_cols).withColumnRenamed("checksum", "signature")
    w = Window.partitionBy(*batch_cols).orderBy(page_col)
    return sig.withColumn("repeated", F.coalesce(F.col("signature") == F.lag("signature").over(w), F.lit(False)))


def require_new_pages(signatures: DataFrame) -> DataFrame:
    """Raise if any page repeats the one before it (one small action); else the signatures."""
    again = signatures.where("repeated").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*signatures.columns)).alias("first")).first()
    if again["n"]:
        raise RuntimeError(f"{again['n']} pages repeat the page before them, first: {again['first'].asDict()}")
    return signatures


def manifest_rows(decisions: DataFrame, name_col: str, file_col: Column, url_col: Column, time: Column | None = None) -> DataFrame:
    """Rows for the append-only manifest (fixed column order); ``time``: of the ingest, else now."""
    return decisions.select(
        F.date_format(time if time is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingest_time"),
        F.col(name_col).cast("string").alias("logical_name"), file_col.alias("stored_filename"),
        url_col.alias("source_url"), F.col("checksum"), F.col("status"), F.col("notes"))


def append_manifest(rows: DataFrame, path: str) -> None:
    rows.select(*MANIFEST_COLUMNS).write.mode("append").parquet(path)


def retention_plan(versions: DataFrame, name_col: str, version_col: str, keep_latest: int = 5) -> DataFrame:
    """Per dataset, the newest ``keep_latest`` distinct version stamps are kept.

    The window runs over distinct (dataset, version) pairs only, a set bounded by the
    number of archived versions, not by data volume."""
    v = versions.select(name_col, version_col).distinct()
    rank = F.dense_rank().over(Window.partitionBy(name_col).orderBy(F.col(version_col).desc()))
    return v.withColumn("version_rank", rank).withColumn("keep", F.col("version_rank") <= keep_latest)


def latest_per_key(df: DataFrame, key: str, time_col: str, tie: str) -> DataFrame:
    """Latest row per key by time (then ``tie``), as a grouped max_by (no window)."""
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(time_col, tie)).alias("__r"))
    return picked.select(key, "__r.*")


def run_manifest_row(panel: DataFrame, entity: str, period: str, source_refs: list[str]) -> DataFrame:
    """What a preprocessing run records of its panel: rows, entities, period range, sources."""
    return panel.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(entity).alias("entity_count"),
                     F.min(period).alias("period_min"), F.max(period).alias("period_max")).withColumn("source_refs", F.lit(";".join(source_refs)))


# Kinds of sources in the catalog.
USABLE, NOT_STATISTICAL, OPENAPI, NOT_FOUND, READ_ERROR = "usable_columns", "not_statistical_records", "openapi_doc", "not_found", "read_error"


def source_kind(columns: list[str] | None, required: list[str], error: Exception | None = None) -> str:
    """Kind of a source from its columns (None: there is no such source)."""
    if error is not None:
        return READ_ERROR
    if columns is None:
        return NOT_FOUND
    if {"openapi", "paths"} <= set(columns):
        return OPENAPI
    return USABLE if set(required) <= set(columns) else NOT_STATISTICAL


def source_summary(name: str, df: DataFrame, time_col: str | None, required: list[str] = ()) -> DataFrame:
    """One catalog row: rows, column count and kind (schema metadata), first/last year."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if time_col:
        aggs += [F.min(F.year(time_col)).cast("bigint").alias("year_min"),
                 F.max(F.year(time_col)).cast("bigint").alias("year_max")]
    else:
        aggs += [F.lit(None).cast("bigint").alias("year_min"), F.lit(None).cast("bigint").alias("year_max")]
    return df.agg(*aggs).select(F.lit(name).alias("source"), "rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
                                "year_min", "year_max", F.lit(source_kind(df.columns, list(required))).alias("kind"))
