"""Mark and sweep: only expired files go, at any interruption."""

import os

from pyspark.sql import functions as F

from kestrel.sources import sweep as SW
from kestrel.sources.files import write_versioned


def archive(spark, root, versions):
    for v in versions:
        write_versioned(spark.range(20).withColumn("v", F.lit(v)), root, v)


def held(spark, root):
    return {r.version for r in spark.read.parquet(root).select(F.col("version").cast("string").alias("version")).distinct().collect()}


def test_only_expired_versions_go_and_a_second_sweep_finishes(spark, tmp_path):
    a, b = (str(tmp_path / "archive" / x) for x in ("a", "b"))
    archive(spark, a, [f"2024010{i}T000000Z" for i in range(1, 8)])
    archive(spark, b, ["20230101T000000Z"])
    root = str(tmp_path / "archive")
    assert SW.expired_versions(spark, root, 5, grace_seconds=3600).count() == 0  # all are too young
    marked = SW.expired_versions(spark, root, 5, grace_seconds=0)
    paths = sorted(r.path for r in marked.collect())
    assert paths and {p.split("version=")[1].split("/")[0] for p in paths} == {"20240101T000000Z", "20240102T000000Z"}
    os.remove(paths[0].removeprefix("file:"))  # an earlier sweep got so far
    done = SW.sweep(marked.unionByName(spark.createDataFrame([(paths[0], 1)], "path string, bytes bigint")).dropDuplicates(["path"])).collect()
    assert sorted((r.path, r.deleted) for r in done) == [(p, p != paths[0]) for p in paths]
    assert held(spark, a) == {f"2024010{i}T000000Z" for i in range(3, 8)} and held(spark, b) == {"20230101T000000Z"}
    assert SW.sweep(SW.expired_versions(spark, root, 5, grace_seconds=0)).collect() == []


def test_files_without_a_reference(spark, tmp_path):
    root = str(tmp_path / "data")
    spark.range(4).repartition(4).write.parquet(root)
    files = sorted(r.path for r in SW.listing(spark, root).collect())
    live = spark.createDataFrame([(p,) for p in files[:-1]], "path string")
    assert [r.path for r in SW.unreferenced(spark, root, live, grace_seconds=0).collect()] == files[-1:]
    assert SW.unreferenced(spark, root, live, grace_seconds=3600).count() == 0


def test_leftovers_of_the_shared_folder_are_listed_once_old(spark):
    from kestrel.session import cut_lineage
    cut_lineage(spark.range(3))
    assert SW.leftovers(spark, grace_seconds=3600).count() == 0
    assert SW.leftovers(spark, grace_seconds=-1).count() > 0
