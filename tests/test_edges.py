"""Edge rows: guards, exactly-once ingest, exact keys, empty bins, JSON types, skew."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.functions.distributions import f_sf, t_two_sided
from kestrel.operators import clean as C
from kestrel.operators import explore as X
from kestrel.operators import ml as ML
from kestrel.operators import model as M
from kestrel.operators import panel as P
from kestrel.operators import validate as V
from kestrel.operators import views as VW
from kestrel.plans import q_clean
from kestrel.plans.testdata import table
from kestrel.sources import files as SF
from kestrel.sources import ingest as I
from kestrel.sources import records as R
from kestrel.spec import MetricSpec, PanelSpec
from kestrel.streaming import landing

from conftest import SF_SMALL


def test_typed_key_keeps_large_integers(spark):
    big = 9007199254740993  # 2**53 + 1
    df = spark.createDataFrame([(big, str(big), 7.0)], "a bigint, b string, c double")
    got = df.select(C.typed_key("a", df.schema["a"].dataType), C.typed_key("b"), C.typed_key("c", df.schema["c"].dataType)).first()
    assert tuple(got) == (big, big, 7)
    with pytest.raises(Exception, match="non-integer"):
        spark.createDataFrame([("7,5",)], "k string").select(C.typed_key("k")).collect()


def test_keep_last_requires_an_order_and_keeps_the_last_landed_row(spark):
    folder = tempfile.mkdtemp(prefix="kestrel-order-")
    with open(os.path.join(folder, "a.csv"), "w") as out:
        out.write("k,t,v\n1,2000,9.0\n1,2000,3.0\n")
    scan = SF.with_ingest_order(spark.read.option("header", True).schema("k int, t int, v double").csv(folder))
    assert C.keep_last(scan, ["k", "t"], ["ingest_order"]).first().v == 3.0
    with pytest.raises(ValueError, match="order"):
        C.keep_last(scan, ["k", "t"], [])
    ds = C.DatasetSpec("s", metric="v", entity="k", period="t", order_col="ingest_order")
    cleaned, profile = C.clean_dataset(scan, ds)
    assert cleaned.first().v == 3.0 and profile.first().duplicate_key_rows == 2
    with pytest.raises(ValueError, match="ordinal"):
        C.clean_dataset(scan.drop("ingest_order"), ds)


def test_scrub_profile_counts_every_kind_of_dirt(spark):
    rows = [(1, 2000, 1, 5.0), (1, 2000, 1, 5.0), (1, 2000, 2, 6.0), (1, 2001, 3, 0.0), (1, 2002, 4, 8.0), (None, 2000, 5, 1.0), (2, 2000, 6, None)]
    df = spark.createDataFrame(rows, "k int, t int, id int, v double")
    cleaned, profile = C.clean_dataset(df, C.DatasetSpec("s", metric="v", entity="k", period="t", id_col="id"))
    p = profile.first().asDict()
    assert (p["rows_raw"], p["rows_clean"], p["missing_values_before"], p["rows_dropped_missing_keys"]) == (7, 4, 2, 1)
    assert (p["duplicate_key_rows"], p["exact_duplicate_rows"], p["invalid_zero_values"], p["imputed_values"]) == (3, 1, 1, 1)
    assert p["missing_metric_before_impute"] == 2 and p["missing_values_after"] == 1
    got = {(r.k, r.t): (r.v, r.v_was_imputed) for r in cleaned.collect()}
    assert got == {(1, 2000): (6.0, False), (1, 2001): (7.0, True), (1, 2002): (8.0, False), (2, 2000): (None, False)}


def test_scrub_profile_reads_each_source_once(spark):
    df = q_clean.quality_profile(spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert plan.count("FileScan parquet") == 3
    assert plan.count("Exchange hashpartitioning") <= 9


def test_histogram_has_all_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (12.0,), (None,)], "x double")
    got = {r.bin: r["count"] for r in X.histogram(df, "x", 12).collect()}
    assert got == {1: 1, 2: 1, **{b: 0 for b in range(3, 12)}, 12: 1}
    flat = X.histogram(spark.createDataFrame([(4.0,), (4.0,)], "x double"), "x", 12).orderBy("bin").collect()
    assert len(flat) == 12 and sum(r["count"] for r in flat) == 2 and (flat[0].lower, flat[-1].upper) == (3.5, 4.5)
    assert X.histogram(spark.createDataFrame([], "x double"), "x", 12).count() == 0


@pytest.mark.parametrize("text,want", [
    ('{"data": ["{x"]}', []), ('{"data": "{\\"a\\":1}"}', []), ('["{x}"]', []), ('[{"a":1},2]', ['{"a":1}']),
    ('{"data":{"c":3}}', ['{"c":3}']), ('{"z":[1],"y":[{"q":1}]}', ['{"q":1}']), ('{"openapi":"3","paths":{}}', []), ("nonsense", []), (None, []),
])
def test_records_go_by_json_type(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(R.record_array(F.col("t")).alias("r")).first().r == want


def test_statistics_without_room_give_null_not_errors(spark):
    one = spark.createDataFrame([(0, 1.0), (0, 2.0)], "cluster_id int, x double")
    assert M.anova(one, ["x"]).first().anova_f is None
    each = spark.createDataFrame([(0, 1.0), (1, 2.0)], "cluster_id int, x double")
    assert M.anova(each, ["x"]).first().anova_f is None
    single = spark.createDataFrame([(1, 2)], "a int, b int")
    assert M.adjusted_rand(single, "a", "b").first().adjusted_rand == 1.0
    assert ML.calinski_harabasz(one, ["x"], "cluster_id").first().calinski_harabasz is None
    nobody = M.two_group_stats(one.withColumn("g", F.lit("c")), "g", "a", "b", ["x"]).first()
    assert nobody.cohens_d is None and nobody.welch_p is None


def test_tail_probabilities_for_large_degrees_of_freedom():
    assert f_sf(3.0, 2, 1e12) == pytest.approx(np.exp(-3.0), rel=1e-9)  # chi-squared with 2 degrees of freedom
    assert f_sf(3.0, 2, 1e6) == pytest.approx((1 + 6 / 1e6) ** (-5e5), rel=1e-9)  # closed form for d1 = 2
    assert t_two_sided(1.959963984540054, 1e12) == pytest.approx(0.05, rel=1e-9)
    assert t_two_sided(2.0, 1e6) == pytest.approx(0.0455, abs=1e-4)


def test_member_lists_have_one_schema_at_any_size(spark):
    schemas = set()
    for n in (3, 20_000):
        df = spark.range(n).select((F.col("id") % 3).cast("int").alias("cluster_id"), F.concat(F.lit("n"), "id").alias("name"))
        members = M.group_members(df, ["cluster_id"], "name")
        assert members.count() == n
        schemas.add(members.schema.simpleString())
    assert len(schemas) == 1


def test_global_ordinal_with_an_outlier_is_balanced_and_exact(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") == 7, 1e12).otherwise(F.col("id") % 100).cast("double").alias("s"))
    out = VW.global_ordinal(df, "s", "id").collect()
    want = {r.id: i for i, r in enumerate(sorted(df.collect(), key=lambda r: (-r.s, r.id)), 1)}
    assert {r.id: r.order_no for r in out} == want
    ranged = df.repartitionByRange(8, F.col("s").desc(), "id").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ranged) < 3 * 20_000 / 8


def test_all_failing_checks_are_named(spark):
    checks = spark.createDataFrame([(f"check_{i}", "FAIL") for i in range(30)], "check_name string, status string")
    with pytest.raises(RuntimeError, match="check_29"):
        V.raise_on_failure(checks)


def test_missing_metric_column_is_a_failed_check(spark):
    spec = PanelSpec(entity="e", period="t", metrics=(MetricSpec("m"), MetricSpec("gone")))
    df = spark.createDataFrame([(1, 1, 1.0, 0.5, 1, 2)], f"e bigint, t bigint, m double, {spec.score_col} double, priority_rank bigint, n_score_components int")
    got = {r.check_name: r.status for r in V.validation_checks(df, spec).collect()}
    assert got["required_columns_present"] == "FAIL" and len(got) >= 10


def test_guards(spark):
    snap = spark.createDataFrame([(1, 1.0), (2, None), (3, 2.0)], "e int, x double")
    with pytest.raises(RuntimeError, match="no rows"):
        P.require_cases(snap.where("e > 9"), ["x"])
    with pytest.raises(RuntimeError, match="2 complete"):
        P.require_cases(snap, ["x"])
    assert P.require_cases(snap, ["x"], least=2) == 1
    pages = spark.createDataFrame([(1, 1, "a", False), (1, 2, "a", True)], "b int, page int, signature string, repeated boolean")
    with pytest.raises(RuntimeError, match="repeat"):
        I.require_new_pages(pages)
    assert I.require_new_pages(pages.where("page = 1")).count() == 1
    assert [I.source_kind(*a) for a in ((None, ["x"]), (["x"], ["x"]), (["y"], ["x"]), (["openapi", "paths"], ["x"]))] == [
        "not_found", "usable_columns", "not_statistical_records", "openapi_doc"]
    assert I.source_kind(None, [], OSError()) == "read_error"


def test_expected_names_list_hits_and_misses(spark):
    df = spark.createDataFrame([("A", 0), ("B", 2), ("C", 1)], "n string, c int")
    got = {(r.side, r.name): r.hit for r in M.expectation_names(df, "n", "c", ["A", "C", "Z"], ["B"], 3).collect()}
    assert got == {("high", "A"): True, ("high", "C"): False, ("high", "Z"): False, ("low", "B"): True}


def test_best_k_takes_the_largest_silhouette_and_the_smaller_k_on_a_tie(spark):
    df = spark.createDataFrame([(2, 0.3), (3, 0.5), (4, 0.5), (5, None)], "k int, silhouette_sq_euclidean double")
    assert ML.best_k(df) == 3


def test_tables_are_listed_anew(spark):
    folder = tempfile.mkdtemp(prefix="kestrel-table-")
    spark.range(10).write.parquet(f"{folder}/t.parquet")
    assert table(spark, folder, "t").count() == 10
    spark.range(5).write.mode("append").parquet(f"{folder}/t.parquet")
    assert table(spark, folder, "t").count() == 15


def test_landing_ingest_is_exactly_once_when_the_manifest_write_fails(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="kestrel-once-")
    source = spark.range(12).select("id", (F.col("id") % 4).alias("v"))
    source.coalesce(1).write.parquet(f"{root}/landing")
    where = [f"{root}/{x}" for x in ("archive", "manifest", "checkpoint")]

    def start():
        return landing.start_landing_ingest(spark, f"{root}/landing", source.schema, *where, "t")

    real = landing.write_manifest
    monkeypatch.setattr(landing, "write_manifest", lambda rows, path: (_ for _ in ()).throw(OSError("storage is away")))
    with pytest.raises(Exception, match="storage is away"):
        start().awaitTermination(120)
    monkeypatch.setattr(landing, "write_manifest", real)
    start().awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(where[0]).collect()) == list(range(12))
    assert [r.status for r in spark.read.parquet(where[1]).collect()] == ["success"]
    # the same content landed again is skipped, whatever the micro-batch
    source.coalesce(1).write.mode("append").parquet(f"{root}/landing")
    start().awaitTermination(120)
    assert spark.read.parquet(where[0]).count() == 12
    assert sorted(r.status for r in spark.read.parquet(where[1]).collect()) == ["skipped", "success"]


def test_processed_panel_prunes_to_one_period(spark):
    from kestrel.plans.q_panel import features_panel
    feat = features_panel(spark, SF_SMALL)
    plan = feat.where("period = 1997").select("entity")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "ReadSchema: struct<entity:" in plan
