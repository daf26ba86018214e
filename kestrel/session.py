"""Spark session and lineage helpers.

Everything in the library is lazy DataFrame code; this module only holds the few
places where we touch session state: building a local session for tests/bench,
resolving the shared folder, and cutting lineage.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "kestrel") -> SparkSession:
    """Session for tests, the bench and the driver smoke run (local mode only)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "8g"))
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix=f"{app}-shared-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings this library assumes on a cluster (set by the deployment, not by the library).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",                      # runtime join / partition re-planning
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",  # target shuffle partition size
    "spark.sql.adaptive.skewJoin.enabled": "true",              # splits hot join partitions
    "spark.sql.shuffle.partitions": "8000",                     # upper bound; AQE coalesces down
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",              # file-size checked broadcast
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",     # runtime-size checked broadcast
    "spark.checkpoint.dir": "<shared folder, e.g. the cluster's distributed file system>",
}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the one named by ``spark.checkpoint.dir``. Only a session
    without that setting (tests) gets a folder beside its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints").rstrip("/")


def cut_lineage(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write the frame once as Parquet in the shared folder and read it back: several readers
    share one computation, a lost executor costs nothing, and later steps keep column pruning,
    filter pushdown, file statistics and (with ``partition_by``) partition pruning."""
    path = f"{checkpoint_dir(df.sparkSession)}/handoff/{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        # together by period, and by measured size: small periods share a task, a large one is written by as many as it fills
        writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])
