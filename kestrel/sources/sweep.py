"""Removal of files that no live version refers to: mark, wait, sweep.

Mark: the listing of a folder (names and times only) without the files that are still referred to, by
an anti-join, so neither side need fit anywhere. Only files older than a grace time count: what a running job
has written but not yet recorded is younger. Sweep: tasks delete the marked files, each its own share,
on whatever file system the path names. Both can be repeated: a crash between, or within, leaves some marked
files for the next run, and a file that is gone already is no error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import checkpoint_dir, cut_lineage
from kestrel.sources.ingest import retention_plan

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRACE_SECONDS = 7 * 24 * 3600
SWEPT = "path string, bytes bigint, deleted boolean"


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, modified) of every file below ``root``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true").load(root)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def _older(grace_seconds: int, now: Column | None) -> Column:
    return F.col("modified") <= F.timestamp_add("SECOND", F.lit(-grace_seconds), now if now is not None else F.current_timestamp())


def expired_versions(spark: SparkSession, root: str, keep_latest: int = 5, grace_seconds: int = GRACE_SECONDS, now: Column | None = None) -> DataFrame:
    """Files (path, bytes) below ``root/.../version=<id>/`` of versions that retention lets go. A dataset is the folder
    its versions lie in. Versions kept: the newest ``keep_latest`` of each."""
    files = listing(spark, root).withColumns({
        "dataset": F.regexp_extract("path", r"^(.*)/version=[^/]+/", 1), "version": F.regexp_extract("path", r"/version=([^/]+)/", 1)}).where("version != ''")
    live = retention_plan(files, "dataset", "version", keep_latest).where("keep").select("dataset", "version")
    return files.join(live, ["dataset", "version"], "left_anti").where(_older(grace_seconds, now)).select("path", "bytes")


def unreferenced(spark: SparkSession, root: str, live: DataFrame, grace_seconds: int = GRACE_SECONDS, now: Column | None = None) -> DataFrame:
    """Files (path, bytes) below ``root`` whose path is not among ``live`` (column path), as a manifest names them."""
    return listing(spark, root).join(live.select("path").distinct(), "path", "left_anti").where(_older(grace_seconds, now)).select("path", "bytes")


def leftovers(spark: SparkSession, grace_seconds: int = GRACE_SECONDS, now: Column | None = None) -> DataFrame:
    """Hand-off tables in the shared folder that earlier runs have left: nobody refers to them after
    their session, which the grace time must outlast."""
    from pyspark.errors import AnalysisException
    out = None
    for part in ("handoff", "tables", "shards"):
        try:
            files = listing(spark, f"{checkpoint_dir(spark)}/{part}").where(_older(grace_seconds, now)).select("path", "bytes")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            continue
        out = files if out is None else out.unionByName(files)
    return out if out is not None else spark.createDataFrame([], "path string, bytes bigint")


def _delete():
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pfs
        for batch in batches:
            gone = []
            for path in batch["path"]:
                # Spark writes local paths as file:/x
                system, name = pfs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path[len("file:"):])
                there = system.get_file_info(name).type != pfs.FileType.NotFound
                if there:
                    system.delete_file(name)
                gone.append(there)
            yield batch.assign(deleted=gone)
    return run


def sweep(marked: DataFrame, tasks: int = 32) -> DataFrame:
    """Delete the marked files (path, bytes). The marks are fixed first, so that a task that runs twice
    can't mark anew; SWEPT says what went (a file that was gone already: false)."""
    fixed = cut_lineage(marked.select("path", "bytes"))
    return cut_lineage(fixed.repartition(tasks, "path").mapInPandas(_delete(), SWEPT))
