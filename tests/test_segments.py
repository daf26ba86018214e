"""Two-level scans and ranks: equal to the plain windows, and no entity or period in one task."""

import random

import pytest
from pyspark.sql import functions as F

from kestrel.operators import clean as C
from kestrel.operators import features as FT
from kestrel.operators import segments as SG
from kestrel.spec import MetricSpec, PanelSpec

SPEC = PanelSpec(entity="e", period="t", metrics=(MetricSpec("a", "A"), MetricSpec("b", "B")), trend_metric="a", score_col="score")


def rows(seed, hot=300, others=25):
    rng = random.Random(seed)
    value = lambda: None if rng.random() < 0.45 else round(rng.uniform(-5, 5), 2) + 0.0
    out = [("hot", t, value(), value()) for t in rng.sample(range(-100, 1000), hot)]
    for i in range(others):
        out += [(f"e{i}", t, value(), value()) for t in rng.sample(range(-20, 60), rng.randint(1, 20))]
    return out + [(None, t, value(), value()) for t in (1, 2, 30, 31)] + [("void", t, None, None) for t in (-9, 9, 99)]


def table(spark, seed=1, **more):
    return spark.createDataFrame(rows(seed, **more), "e string, t bigint, a double, b double").repartition(5)


def collected(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def segment(df, width):
    out = SG.segment_of(df, "t", width)
    assert out is not None
    return out


@pytest.mark.parametrize("seed,width", [(1, 7), (2, 64), (3, 1)])
def test_scans_equal_the_plain_windows(spark, seed, width):
    df = table(spark, seed).cache()
    seg = segment(df, width)
    assert collected(C.interpolate_linear(df, "e", ["t"], "a", segment=seg)) == collected(C.interpolate_linear(df, "e", ["t"], "a"))
    assert collected(FT.add_changes(df, SPEC, segment=seg)) == collected(FT.add_changes(df, SPEC))
    for n in (1, 3, 5):
        got = collected(FT.add_rolling_mean(df, SPEC, window=n, name="m", segment=seg).withColumn("m", F.round("m", 9)))
        assert got == collected(FT.add_rolling_mean(df, SPEC, window=n, name="m").withColumn("m", F.round("m", 9)))


def test_one_segment_needs_nothing(spark):
    df = table(spark)
    assert SG.segment_of(df, "t", 1 << 20) is not None  # negative periods lie in another one
    assert SG.segment_of(df.where("t >= 0"), "t", 1 << 20) is None
    assert SG.segment_of(df.limit(0), "t") is None
    assert SG.segment_of(df, "a") is None  # no integer


def test_a_hot_entity_spreads_over_tasks(spark):
    df = table(spark, hot=900, others=5).where("t is not null")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        seg = segment(df, 50)
        for out in (C.interpolate_linear(df, "e", ["t"], "a", segment=seg), FT.add_changes(df, SPEC, segment=seg)):
            tasks = out.where("e = 'hot'").groupBy(F.spark_partition_id()).count().collect()
            assert len(tasks) >= 5 and max(r["count"] for r in tasks) < 450
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_frames(spark):
    df = table(spark)
    seg = segment(df, 10)
    assert C.interpolate_linear(df.limit(0), "e", ["t"], "a", segment=seg).collect() == []
    assert FT.add_rolling_mean(df.limit(0), SPEC, segment=seg).collect() == []


@pytest.mark.parametrize("bucket", [1, 3, 1 << 16])
def test_two_level_ranks_equal_the_window(spark, monkeypatch, bucket):
    monkeypatch.setattr(FT, "RANK_BUCKET", bucket)
    rng = random.Random(bucket)
    data = [(f"e{i}", rng.randrange(3), None if rng.random() < 0.1 else round(rng.choice([rng.uniform(-0.002, 0.002), rng.uniform(-3, 3)]), 4)) for i in range(400)]
    df = spark.createDataFrame(data, "e string, t bigint, score double")
    assert collected(FT.add_ranks(df, SPEC)) == collected(FT.add_ranks(df, SPEC, strategy="window"))


def test_a_period_of_many_scores_is_balanced(spark, monkeypatch):
    monkeypatch.setattr(FT, "RANK_BUCKET", 1000)
    df = spark.range(200_000).select(F.col("id").cast("string").alias("e"), F.lit(1).cast("bigint").alias("t"), (F.col("id") / 10_000).alias("score"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranks = FT.rank_table(df, SPEC)
        per_task = [r["count"] for r in ranks.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) >= 6 and max(per_task) < 60_000
        assert ranks.agg(F.min("priority_rank"), F.max("priority_rank"), F.count_distinct("priority_rank")).first()[:] == (1, 200_000, 200_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _compressible(spark):
    return spark.createDataFrame([(e, p, e * 100 + p, None if (e + p) % 3 == 0 else float(p + 1)) for e in range(40) for p in range(12)],
                                 "e bigint, p bigint, i bigint, m double")


def test_tasks_of_the_entity_windows_follow_the_rows(spark):
    # rows that compress well are small in bytes: sized by these, one task would hold them all
    raw, spec = _compressible(spark), dict(metric="m", entity="e", period="p", id_col="i")
    plain, counts = C.clean_dataset(raw, C.DatasetSpec("d", **spec))
    cut, cut_counts = C.clean_dataset(raw, C.DatasetSpec("d", **spec, task_rows=40))
    assert sorted(cut.collect(), key=str) == sorted(plain.collect(), key=str)
    assert cut_counts.collect() == counts.collect()
    assert SG.extent(raw, "p", task_rows=40) == (None, 12) and SG.extent(raw.limit(0), "p") == (None, 1)
    assert cut.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 480 / 3


def test_segments_dealt_over_tasks_equal_the_plain_windows(spark):
    raw = _compressible(spark)
    segment, tasks = SG.extent(raw, "p", 4, 40)
    cut = C.interpolate_linear(raw, "e", ["p"], "m", segment=segment, tasks=tasks)
    assert segment is not None and sorted(cut.collect(), key=str) == sorted(C.interpolate_linear(raw, "e", ["p"], "m").collect(), key=str)
