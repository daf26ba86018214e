"""Unit tests on hand-written edge rows (one per operator rule)."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException  # noqa: F401

from kestrel import spec as S
from kestrel.functions import text as T
from kestrel.functions.distributions import f_sf, t_two_sided
from kestrel.functions.labels import priority_bucket, slope_label, trend_direction
from kestrel.operators import clean as C
from kestrel.operators import explore as X
from kestrel.operators import features as FT
from kestrel.operators import joins as J
from kestrel.operators import model as M
from kestrel.spec import MetricSpec, PanelSpec

SPEC1 = PanelSpec(entity="e", period="t", metrics=(MetricSpec("m", risk=S.HIGH_IS_RISKY),), trend_metric="m")
SERIES = [(1, 1, None), (1, 2, 1.0), (1, 3, None), (1, 5, 3.0), (1, 6, None), (1, 7, None)]


def series(spark):
    return spark.createDataFrame(SERIES, "e int, t int, m double")


def by_t(df, col):
    return [r[col] for r in df.orderBy("t").collect()]


def test_interpolate_interior_by_position(spark):
    out = C.interpolate_linear(series(spark), "e", ["t"], "m")
    assert by_t(out, "m") == [None, 1.0, 2.0, 3.0, None, None]


def test_rolling_mean_min_periods_one(spark):
    out = FT.add_rolling_mean(series(spark), SPEC1, "m", 3, "r")
    assert by_t(out, "r") == [None, 1.0, 1.0, 2.0, 3.0, 3.0]


def test_diff_previous_row_null_when_either_null(spark):
    out = FT.add_changes(series(spark), SPEC1)
    assert by_t(out, "m_yoy_change") == [None] * 6


def test_pct_change_zero_previous_is_null(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 5.0), (2, 1, 1.0), (2, 2, 0.0)], "e int, t int, m double")
    out = {(r.e, r.t): r.m_yoy_pct_change for r in FT.add_changes(df, SPEC1).collect()}
    assert out[(1, 2)] is None and out[(2, 2)] == -100.0


@pytest.mark.parametrize("strategy", ["distinct", "window"])
def test_dense_and_pct_rank(spark, strategy):
    df = spark.createDataFrame([(1, 0, 3.0), (2, 0, 1.0), (3, 0, None), (4, 0, 3.0)], "e int, t int, score double")
    spec = PanelSpec(entity="e", period="t", metrics=SPEC1.metrics)
    out = {r.e: (r.priority_rank, r.priority_pct) for r in FT.add_ranks(df, spec, strategy=strategy).collect()}
    assert out[1] == (1, pytest.approx(1 / 3)) and out[4] == (1, pytest.approx(1 / 3))
    assert out[2] == (2, 1.0) and out[3] == (None, None)


def test_keep_last_null_id_wins(spark):
    df = spark.createDataFrame([(1, 2000, 2, 10.0), (1, 2000, None, 20.0), (1, 2000, 1, 30.0)],
                               "k int, t int, id int, v double")
    out = C.keep_last(df, ["k", "t"], ["id"]).collect()
    assert len(out) == 1 and out[0].v == 20.0


def test_keep_last_is_partitioning_invariant(spark):
    df = spark.range(2000).select((F.col("id") % 37).alias("k"), F.lit(1).alias("t"),
                                  (F.col("id") * 7919 % 101).alias("id2"), F.col("id").cast("double").alias("v"))
    a = sorted(C.keep_last(df, ["k", "t"], ["id2"]).collect())
    b = sorted(C.keep_last(df.repartition(13), ["k", "t"], ["id2"]).collect())
    assert a == b


def test_qcut_duplicate_edges_raise(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 1.0, 1.0, 1.0, 2.0])], "e int, s double")
    with pytest.raises(Exception, match="unique"):
        M.add_tertile_level(df, "s").collect()


def test_percentile_linear(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "x double")
    v = df.agg(F.percentile("x", 0.33).alias("q")).first().q
    assert v == pytest.approx(1.99)


@pytest.mark.parametrize("raw,expected", [
    ("1.234,5", 1234.5), ("1,234.5", 1234.5), ("1,5", 1.5), ("1.234.567", None), ("5-3", None),
    ("1e5", 15.0), ("Rp 10%", 10.0), ("-", None), ("null", None), (" 12 ", 12.0), ("Rp 1.234.567,89", 1234567.89),
])
def test_coerce_numeric(spark, raw, expected):
    v = spark.createDataFrame([(raw,)], "s string").select(T.coerce_numeric("s").alias("v")).first().v
    assert v == (pytest.approx(expected) if expected is not None else None)


def test_normalize_name(spark):
    df = spark.createDataFrame([(" kota  x ",), (None,), ("a  b",)], "s string")
    assert [r.v for r in df.select(T.normalize_name("s").alias("v")).collect()] == ["KOTA X", None, "A B"]


def test_snake_case_and_title(spark):
    assert T.snake_case("  Nama Kabupaten/Kota ") == "nama_kabupaten_kota"
    df = spark.createDataFrame([("bandung-barat kota",)], "s string")
    assert df.select(T.title_words("s").alias("v")).first().v == "Bandung-Barat Kota"


def test_typed_key_rejects_fraction(spark):
    df = spark.createDataFrame([("3201.5",)], "s string")
    with pytest.raises(Exception, match="non-integer"):
        df.select(C.typed_key("s")).collect()


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    r = X.correlation_pairs(df, ["a", "b"]).first()
    assert r.pearson_r is None


def test_cohens_d_edges(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 3.0)], "g string, x double")
    assert M.two_group_stats(df, "g", "a", "b", ["x"], with_p=False).first().cohens_d is None
    df2 = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, x double")
    assert M.two_group_stats(df2, "g", "a", "b", ["x"], with_p=False).first().cohens_d == 0.0


def test_zscore_edges(spark):
    spec = PanelSpec(entity="e", period="t", metrics=(MetricSpec("m"),))
    df = spark.createDataFrame([(1, 1, 5.0), (2, 1, 5.0), (1, 2, 7.0), (1, 3, None), (2, 3, None)],
                               "e int, t int, m double")
    out = {(r.e, r.t): r.m_z for r in FT.add_zscores(df, spec).collect()}
    assert out[(1, 1)] == 0.0 and out[(2, 1)] == 0.0 and out[(1, 2)] == 0.0
    assert out[(1, 3)] is None and out[(2, 3)] is None


def test_priority_bucket_edges(spark):
    df = spark.createDataFrame([(0.2,), (0.5,), (0.8,), (1.0,), (0.21,)], "p double")
    got = [r.b for r in df.select(priority_bucket("p").alias("b")).collect()]
    assert got == ["sangat_tinggi", "tinggi", "sedang", "rendah", "tinggi"]


def test_trend_and_slope_labels(spark):
    df = spark.createDataFrame([(0.2,), (-0.2,), (0.05,), (None,)], "d double")
    assert [r.v for r in df.select(trend_direction("d").alias("v")).collect()] == \
        ["naik", "turun", "stabil", "belum_ada_pembanding"]
    assert [r.v for r in df.select(slope_label("d").alias("v")).collect()] == \
        ["memburuk", "membaik", "stabil", "tidak_diketahui"]


def test_yearly_trend_null_count(spark):
    spec = PanelSpec(entity="e", period="t", metrics=(MetricSpec("m"),))
    df = spark.createDataFrame([(1, 2016, 2.0, None), (1, 2017, 3.0, 0.5)], "e int, t int, m double, score double")
    out = {r.t: r.entities_with_score for r in X.yearly_trend(df, spec).collect()}
    assert out == {2016: None, 2017: 1}


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(13)], "x double")
    out = {r.bin: r["count"] for r in X.histogram(df, "x", 12).collect()}
    assert out[12] == 2 and sum(out.values()) == 13


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("tinggi", "stabil", 2, "B"), ("tinggi", "stabil", 1, "A")],
                               "vulnerability_level string, trend_label string, cluster_id int, name string")
    r = M.priority_matrix(df).first()
    assert r.dominant_cluster_id == 1 and r.priority_action == "intervensi_intensif"


def test_outer_join_key_in_one_input(spark):
    a = spark.createDataFrame([(1, 2000, 1.0, False)], "k int, t int, a double, a_was_imputed boolean")
    b = spark.createDataFrame([(2, 2000, 2.0, True)], "k int, t int, b double, b_was_imputed boolean")
    for out in (J.outer_join_all([a, b], ["k", "t"]), J.union_aggregate([a, b], ["k", "t"])):
        got = {r.k: r for r in out.collect()}
        assert got[1].b is None and got[1].b_was_imputed is None
        assert got[2].a is None and got[2].a_was_imputed is None


def test_first_non_null_dims(spark):
    s0 = spark.createDataFrame([(1, None, "X")], "k int, name string, prov string")
    s1 = spark.createDataFrame([(1, "B", None), (1, "A", None)], "k int, name string, prov string")
    r = J.resolve_dimensions([s0, s1], "k", "name", ["k", "name", "prov"]).first()
    assert r.name == "A" and r.prov == "X"


def test_p_values_against_known_values():
    assert f_sf(3.758, 2, 24) == pytest.approx(0.038034, abs=2e-6)
    assert t_two_sided(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)
    assert math.isnan(f_sf(float("nan"), 2, 3))


def test_adjusted_rand_identical_and_independent(spark):
    df = spark.createDataFrame([(i % 3, i % 3, (i // 3) % 3) for i in range(30)], "a int, b int, c int")
    assert M.adjusted_rand(df, "a", "b").first().adjusted_rand == pytest.approx(1.0)
    assert M.adjusted_rand(df, "a", "c").first().adjusted_rand < 0.1


def test_ingest_decisions_and_retention(spark):
    from kestrel.sources import ingest as I
    batches = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5)], "checksum string, n_records int")
    manifest = spark.createDataFrame([("a", "success"), ("b", "failed")], "checksum string, status string")
    got = {r.checksum: (r.status, r.notes) for r in I.ingest_decisions(batches, manifest).collect()}
    assert got == {"a": ("skipped", "duplicate_checksum"), "b": ("success", ""), "c": ("success", "")}
    versions = spark.createDataFrame([("x", f"2024010{i}T000000Z") for i in range(1, 8)] + [("y", "20240101T000000Z")],
                                     "name string, version string")
    plan = {(r.name, r.version): r.keep for r in I.retention_plan(versions, "name", "version", 5).collect()}
    assert [plan[("x", f"2024010{i}T000000Z")] for i in range(1, 8)] == [False, False, True, True, True, True, True]
    assert plan[("y", "20240101T000000Z")] is True


def test_checksum_is_order_and_partition_insensitive(spark):
    from kestrel.sources import ingest as I
    df = spark.range(200).select((F.col("id") % 3).alias("b"), F.col("id").alias("v"), (F.col("id") * 2).alias("w"))
    a = {r.b: r.checksum for r in I.batch_checksums(df, ["b"], ["v", "w"]).collect()}
    c = {r.b: r.checksum for r in I.batch_checksums(df.orderBy(F.rand(1)).repartition(7), ["b"], ["v", "w"]).collect()}
    assert a == c and len(set(a.values())) == 3


def test_repeated_page_flag(spark):
    from kestrel.sources import ingest as I
    rows = [(1, 1, 10), (1, 1, 11), (1, 2, 10), (1, 2, 11), (1, 3, 12)]
    df = spark.createDataFrame(rows, "batch int, page int, v int")
    got = {r.page: r.repeated for r in I.page_signatures(df, ["batch"], "page", ["v"]).collect()}
    assert got == {1: False, 2: True, 3: False}


def test_flatten_nested(spark):
    from kestrel.sources.records import flatten
    df = spark.createDataFrame([(1, (("x", 2.0),))], "id int, a struct<b: struct<c: string, d: double>>")
    out = flatten(df)
    assert out.columns == ["id", "a.b.c", "a.b.d"] and tuple(out.first()) == (1, "x", 2.0)


def test_many_unscored_rows_get_null_ranks(spark):
    spec = PanelSpec(entity="e", period="t", metrics=SPEC1.metrics)
    df = spark.range(1000).select(F.col("id").alias("e"), F.lit(1).alias("t"),
                                  F.when(F.col("id") < 100, (F.col("id") % 7).cast("double")).alias("score"))
    out = FT.add_ranks(df, spec).cache()
    assert out.count() == 1000
    assert out.where(F.col("score").isNull() & F.col("priority_rank").isNotNull()).count() == 0
    ranks = {r.score: r.priority_rank for r in out.where(F.col("score").isNotNull()).select("score", "priority_rank").distinct().collect()}
    assert ranks == {6.0 - i: i + 1 for i in range(7)}
