"""File sources and sinks: CSV scan with pandas-style missing tokens, newest landed
version, source resolution, report sinks, versioned archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kestrel import spec as S
from kestrel.functions.text import standardize_columns


def scan_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             null_tokens=S.CSV_NULL_TOKENS, standardize: bool = True, ingest_order: str | None = None) -> DataFrame:
    """Header CSV scan. Without a schema every column is read as string (no inference
    pass over the data); the usual missing-value tokens become null. ``ingest_order`` names a
    column for each row's place in its file (see :func:`with_ingest_order`)."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is None:
        header = spark.read.option("header", True).csv(path).schema  # header only
        schema = StructType([StructField(f.name, StringType(), True) for f in header.fields])
    df = reader.schema(schema).csv(path)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType):
            c = F.when(c.isin(*null_tokens), F.lit(None).cast("string")).otherwise(c)
        cols.append(c.alias(f.name))
    if ingest_order:
        df, cols = with_ingest_order(df, ingest_order), [*cols, F.col(ingest_order)]
    out = df.select(*cols)
    return standardize_columns(out) if standardize else out


def with_ingest_order(scan: DataFrame, name: str = "ingest_order") -> DataFrame:
    """Adds the place of each row in its landed file: (file, block, row in the block), an ordinal that
    orders rows as they stand in the file. Call it on the file scan itself."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    return scan.select("*", place.alias(name))


def file_versions(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, name, modified) of landed files, from file metadata only (content not read)."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path).select("path", "modificationTime")
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"),
                        F.col("modificationTime").alias("modified"))


def newest_file(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row: the newest landed file by (modification time, name)."""
    v = file_versions(spark, path, pattern)
    return v.agg(F.max_by(F.struct("path", "name", "modified"), F.struct("modified", "name")).alias("f")).select("f.*")


def resolve_source(spark: SparkSession, csv_path: str | None, json_path: str | None,
                   required: list[str]) -> tuple[str, DataFrame]:
    """Usable CSV first, then usable JSON records, else an error (schema reads only).
    Returns (mode, frame)."""
    from kestrel.sources.records import json_file_records
    errors = []
    if csv_path:
        try:
            df = scan_csv(spark, csv_path)
            if all(c in df.columns for c in required):
                return "csv", df
            errors.append(f"csv missing {[c for c in required if c not in df.columns]}")
        except Exception as exc:  # noqa: BLE001 - any unreadable file falls through
            errors.append(f"csv: {exc}")
    if json_path:
        try:
            df = standardize_columns(json_file_records(spark, json_path))
            if all(c in df.columns for c in required):
                return "json", df
            errors.append(f"json missing {[c for c in required if c not in df.columns]}")
        except Exception as exc:  # noqa: BLE001
            errors.append(f"json: {exc}")
    raise FileNotFoundError("no usable source: " + "; ".join(errors))


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Report sink: header CSV (null → empty) or parquet; no index column."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).option("nullValue", "").csv(path)
    else:
        w.parquet(path)


def write_versioned(df: DataFrame, root: str, version: str, latest_path: str | None = None) -> None:
    """Archive one version under ``root/version=<id>`` and optionally refresh a latest copy."""
    df.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(root)
    if latest_path:
        df.write.mode("overwrite").parquet(latest_path)


def version_stamp(ts_col) -> F.Column:
    """Version id ``yyyyMMdd'T'HHmmss'Z'`` from a UTC timestamp column."""
    return F.date_format(ts_col, "yyyyMMdd'T'HHmmss'Z'")
