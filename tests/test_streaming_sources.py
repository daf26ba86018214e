"""Landing-folder streaming ingest, CSV scan and newest-file selection on small local folders."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from kestrel.plans.testdata import table
from kestrel.sources import files as SF
from kestrel.streaming.landing import start_landing_ingest


def test_landing_ingest_skips_duplicate_content(spark):
    root = tempfile.mkdtemp(prefix="kestrel-land-")
    flat = os.path.join(root, "landing")
    ev = table(spark, SF_SMALL, "events")
    day1 = ev.where(F.dayofmonth("ts") == 1)
    day2 = ev.where(F.dayofmonth("ts") == 2)
    for part in (day1, day2, day1):  # the third file repeats the first one's content
        part.coalesce(1).write.mode("append").parquet(flat)
    q = start_landing_ingest(spark, flat, ev.schema, os.path.join(root, "archive"), os.path.join(root, "manifest"),
                             os.path.join(root, "ckpt"), "events")
    q.awaitTermination(120)
    man = spark.read.parquet(os.path.join(root, "manifest"))
    status = sorted(r.status for r in man.collect())
    assert status == ["skipped", "success", "success"]
    archived = spark.read.parquet(os.path.join(root, "archive"))
    assert archived.count() == day1.count() + day2.count()


def test_scan_csv_null_tokens(spark):
    d = tempfile.mkdtemp(prefix="kestrel-csv-")
    p = os.path.join(d, "x.csv")
    with open(p, "w") as fh:
        fh.write("Kode Kab,Nama Kabupaten/Kota,Nilai\n3201,KAB A,N/A\n3202,KAB B,1.5\n3203,NULL,-\n")
    df = SF.scan_csv(spark, p)
    assert df.columns == ["kode_kab", "nama_kabupaten_kota", "nilai"]
    got = [tuple(r) for r in df.orderBy("kode_kab").collect()]
    assert got == [("3201", "KAB A", None), ("3202", "KAB B", "1.5"), ("3203", None, "-")]


def test_newest_file_by_mtime_then_name(spark):
    d = tempfile.mkdtemp(prefix="kestrel-ver-")
    for name, t in (("raw_x_20240101T000000Z.csv", 100), ("raw_x_20240102T000000Z.csv", 200),
                    ("raw_x_20240103T000000Z.csv", 200)):
        p = os.path.join(d, name)
        with open(p, "w") as fh:
            fh.write("a\n1\n")
        os.utime(p, (t, t))
    assert SF.newest_file(spark, d, "*.csv").first().name == "raw_x_20240103T000000Z.csv"


def test_feature_dictionary_covers_feature_columns(spark):
    from kestrel.operators.features import add_features
    from kestrel.plans.testdata import SMALL_SPEC, small_panel
    from kestrel.sources.dictionary import feature_dictionary
    cols = {r.column for r in feature_dictionary(spark, SMALL_SPEC).collect()}
    feat = add_features(small_panel(spark, SF_SMALL), SMALL_SPEC)
    missing = [c for c in feat.columns if c not in cols and not c.endswith("_risk_z") and c != "group_name"
               and c != "entity_name"]
    assert missing == []


def test_resolve_source_prefers_usable_csv_then_json(spark):
    d = tempfile.mkdtemp(prefix="kestrel-src-")
    csv_ok = os.path.join(d, "ok.csv")
    with open(csv_ok, "w") as fh:
        fh.write("kode_kabupaten_kota,tahun,nilai\n3201,2020,1.5\n")
    csv_bad = os.path.join(d, "bad.csv")
    with open(csv_bad, "w") as fh:
        fh.write("x,y\n1,2\n")
    js = os.path.join(d, "payload.json")
    with open(js, "w") as fh:
        fh.write('{"metadata": {"rows": 2}, "data": [{"kode_kabupaten_kota": 3201, "tahun": 2021, "nilai": 2.5},'
                 ' {"kode_kabupaten_kota": 3202, "tahun": 2021, "nilai": 3.5}]}')
    req = ["kode_kabupaten_kota", "tahun", "nilai"]
    mode, df = SF.resolve_source(spark, csv_ok, js, req)
    assert mode == "csv" and df.count() == 1
    mode, df = SF.resolve_source(spark, csv_bad, js, req)
    assert mode == "json" and sorted(r.nilai for r in df.collect()) == [2.5, 3.5]
    import pytest
    with pytest.raises(FileNotFoundError):
        SF.resolve_source(spark, csv_bad, None, req)


def test_versioned_archive_and_report_sink(spark):
    d = tempfile.mkdtemp(prefix="kestrel-arch-")
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    SF.write_versioned(df, os.path.join(d, "archive"), "20240101T000000Z", os.path.join(d, "latest"))
    SF.write_versioned(df, os.path.join(d, "archive"), "20240102T000000Z", os.path.join(d, "latest"))
    arch = spark.read.parquet(os.path.join(d, "archive"))
    assert sorted(r.version for r in arch.select("version").distinct().collect()) == ["20240101T000000Z", "20240102T000000Z"]
    assert spark.read.parquet(os.path.join(d, "latest")).count() == 2
    SF.write_report(df, os.path.join(d, "report"))
    text = "".join(open(os.path.join(d, "report", f)).read() for f in sorted(os.listdir(os.path.join(d, "report")))
                   if f.endswith(".csv"))
    assert "k,v" in text and "2," in text


def test_assert_panel_guard(spark):
    import pytest
    from kestrel.operators.validate import assert_panel
    from kestrel.spec import MetricSpec, PanelSpec
    spec = PanelSpec(entity="e", period="t", metrics=(MetricSpec("m"),))
    ok = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0)], "e int, t int, m double")
    assert assert_panel(ok, spec) is ok
    with pytest.raises(RuntimeError, match="duplicate"):
        assert_panel(ok.unionByName(ok), spec)
    with pytest.raises(RuntimeError, match="missing keys"):
        assert_panel(spark.createDataFrame([(None, 1, 1.0)], "e int, t int, m double"), spec)
