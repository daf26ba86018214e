"""Incremental, idempotent ingest of landed files with Structured Streaming.

The batch pipeline's obtain step (pull, checksum, skip duplicates, archive a version,
append a manifest row) becomes a file-source stream with ``foreachBatch``:

* every new file in the landing folder is fingerprinted (order-insensitive content hash,
  see ``kestrel.sources.ingest``);
* files whose content already has a ``success`` row in the manifest are recorded as
  ``skipped`` / ``duplicate_checksum``; within one micro-batch the first file (by path)
  of identical content wins;
* new content is written to the archive as one version per micro-batch, then its manifest rows.

Version and manifest rows are named by the stream's id and the micro-batch's number and are
overwritten by a replay, which leaves its own earlier manifest rows out of the duplicate check: a
crash at any point, followed by a replay, archives each landed row exactly once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kestrel.sources import ingest as I

MANIFEST_SCHEMA = StructType([StructField(c, StringType(), True) for c in I.MANIFEST_COLUMNS])


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _read_manifest(spark: SparkSession, path: str, but: str) -> DataFrame:
    """All manifest rows but those of the run ``but`` (a batch never counts as its own duplicate).
    No folder means no manifest yet; any other trouble is raised."""
    if not _exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    rows = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    return rows.where(~F.contains(F.col("_metadata.file_path"), F.lit(f"/run={but}/")))


def _stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The identity a stream keeps as long as its checkpoint: two streams never share a version."""
    return json.loads(spark.read.text(f"{checkpoint_location.rstrip('/')}/metadata").first()[0])["id"]


def decide_batch(batch: DataFrame, manifest: DataFrame, record_cols: list[str]) -> DataFrame:
    """Per landed file: checksum, record count, status and notes."""
    sums = I.batch_checksums(batch, ["source_file"], record_cols)
    decided = I.ingest_decisions(sums, manifest)
    first = F.row_number().over(Window.partitionBy("checksum").orderBy("source_file")) == 1
    return decided.withColumns({
        "status": F.when((F.col("status") == I.SUCCESS) & ~first, F.lit(I.SKIPPED)).otherwise(F.col("status")),
        "notes": F.when((F.col("status") == I.SUCCESS) & ~first, F.lit("duplicate_checksum")).otherwise(F.col("notes")),
    })


def write_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def start_landing_ingest(spark: SparkSession, landing_dir: str, schema: StructType, archive_dir: str,
                         manifest_dir: str, checkpoint_location: str, name: str, fmt: str = "parquet",
                         record_cols: list[str] | None = None, available_now: bool = True,
                         max_files_per_trigger: int = 1000):
    """Start the ingest stream; returns the StreamingQuery."""
    record_cols = record_cols or [f.name for f in schema.fields]
    stream = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(landing_dir)
              .withColumn("source_file", F.col("_metadata.file_path")))

    def process(batch: DataFrame, epoch_id: int) -> None:
        bs = batch.sparkSession
        run = f"{_stream_id(bs, checkpoint_location)}-{epoch_id:010d}"
        decisions = decide_batch(batch, _read_manifest(bs, manifest_dir, run), record_cols)
        decisions = decisions.cache()  # small: one row per landed file of this micro-batch
        keep = decisions.where(F.col("status") == I.SUCCESS).select("source_file")
        # A replayed micro-batch has the same id and files: it overwrites its own archive version and
        # its own manifest rows, and touches nothing else.
        batch.join(keep, "source_file", "left_semi").write.mode("overwrite").parquet(f"{archive_dir.rstrip('/')}/version={run}")
        rows = I.manifest_rows(decisions.withColumn("__name", F.lit(name)), "__name",
                               F.element_at(F.split("source_file", "/"), -1), F.col("source_file"))
        write_manifest(rows, f"{manifest_dir.rstrip('/')}/run={run}")
        decisions.unpersist()

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
