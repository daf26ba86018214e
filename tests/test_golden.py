"""Parity with the original pipeline's published outputs, recomputed by this library from
the original raw data files (read as data only). The files are found by their header
columns under $KESTREL_GOLDEN_DIR; the module is skipped when it is not set.
The poverty-line source is not shipped with the raw files, so its columns are skipped.
Means that land exactly on a rounding half depend on summation order: tolerance 1e-4."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kestrel.operators import explore as X
from kestrel.operators import ml as ML
from kestrel.operators import model as M
from kestrel.operators import validate as V
from kestrel.operators.silhouette import silhouette
from kestrel.plans import regional as RG

GOLDEN_DIR = os.environ.get("KESTREL_GOLDEN_DIR")
pytestmark = pytest.mark.skipif(not GOLDEN_DIR or not os.path.isdir(GOLDEN_DIR),
                                reason="set KESTREL_GOLDEN_DIR to a folder with the original data and report CSVs")
TOL = 1.01e-4


def _csv_headers():
    out = []
    for root, _, files in os.walk(GOLDEN_DIR):
        for f in sorted(files):
            if f.endswith(".csv"):
                path = os.path.join(root, f)
                with open(path, encoding="utf-8") as fh:
                    out.append((path, fh.readline().strip().split(",")))
    return sorted(out)


def find(*cols, exclude=()):
    """Path of the CSV whose header has every column in ``cols`` and none in ``exclude``
    (files are recognised by content, not by name)."""
    hits = [p for p, h in _csv_headers() if all(c in h for c in cols) and not any(x in h for x in exclude)]
    assert hits, cols
    return hits[0]


def golden(*cols, exclude=()):
    return pd.read_csv(find(*cols, exclude=exclude))


def raw_sources():
    """Raw indicator files: one per source (the first of identical copies)."""
    out = {}
    for name, metric, *_ in RG.SOURCES:
        hits = [p for p, h in _csv_headers() if metric in h and "id" in h and "satuan" in h]
        if hits:
            out[name] = hits[0]
    return out


def close(a, b, tol=TOL):
    if b is None or (isinstance(b, float) and np.isnan(b)):
        return a is None
    return a is not None and abs(a - b) <= tol


@pytest.fixture(scope="module")
def built(spark):
    panel, profile, spec = RG.build_panel(spark, raw_sources())
    from kestrel.session import cut_lineage
    return cut_lineage(panel), profile, spec


@pytest.fixture(scope="module")
def snapshot(built):
    panel, _, spec = built
    return panel.where(F.col("tahun") == 2024)


@pytest.fixture(scope="module")
def regions():
    return golden("cluster_vulnerability_tier", "pc1").set_index("kode_kabupaten_kota")


def test_scores_2024(snapshot, regions):
    got = {r.kode_kabupaten_kota: r.skor_kerentanan_sosial for r in snapshot.collect()}
    assert len(got) == 27
    for code, row in regions.iterrows():
        assert got[code] == pytest.approx(row.skor_kerentanan_sosial, abs=TOL)


def test_quality_profile(built):
    _, profile, _ = built
    gold = golden("rows_raw", "logical_name").set_index("logical_name")
    for r in profile.collect():
        g = gold.loc[r.logical_name]
        for c in ("rows_raw", "rows_clean", "missing_values_before", "missing_values_after",
                  "missing_metric_before_impute", "imputed_values", "invalid_zero_values",
                  "rows_dropped_missing_keys", "duplicate_key_rows", "exact_duplicate_rows"):
            assert r[c] == g[c], (r.logical_name, c)


def test_coverage_and_yearly_trend(built):
    panel, _, spec = built
    cov = {r.tahun: r for r in V.coverage_by_period(panel, spec).collect()}
    for _, g in golden("tahun", "tingkat_pengangguran_terbuka", exclude=("regions_with_score", "id", "kode_kabupaten_kota")).iterrows():
        for m in spec.metric_names:
            assert cov[g.tahun][m] == g[m], (g.tahun, m)
    trend = {r.tahun: r for r in X.yearly_trend(panel, spec).collect()}
    for _, g in golden("regions_with_score").iterrows():
        for m in spec.metric_names:
            assert close(trend[g.tahun][m], g[m]), (g.tahun, m)
        want = None if pd.isna(g.regions_with_score) else int(g.regions_with_score)
        assert trend[g.tahun].entities_with_score == want


def test_region_change(built):
    panel, _, spec = built
    got = {r.kode_kabupaten_kota: r for r in X.entity_change(panel, spec).collect()}
    gold = golden("perubahan_poin")
    assert len(got) == len(gold)
    for _, g in gold.iterrows():
        r = got[g.kode_kabupaten_kota]
        assert (r.period_first, r.period_last, r.nama_kabupaten_kota) == (g.tahun_awal, g.tahun_akhir, g.nama_kabupaten_kota)
        assert r.change == pytest.approx(g.perubahan_poin, abs=TOL)


def test_group_comparison_and_top_bottom(snapshot, built):
    _, _, spec = built
    got = {r.entity_type: r for r in X.group_comparison(snapshot, spec, "nama_kabupaten_kota").collect()}
    for _, g in golden("tipe_administratif", "jumlah_wilayah", exclude=("cluster_id",)).iterrows():
        assert got[g.tipe_administratif].n_entities == g.jumlah_wilayah
        for m in spec.metric_names:
            assert got[g.tipe_administratif][m] == pytest.approx(g[m], abs=TOL)
    tb = X.top_bottom(snapshot, spec, 5, ["kode_kabupaten_kota", "nama_kabupaten_kota", "skor_kerentanan_sosial"])
    got = sorted((r.group, r.nama_kabupaten_kota) for r in tb.collect())
    gold = golden("kelompok")
    assert got == sorted(zip(gold.kelompok, gold.nama_kabupaten_kota))


def test_describe_and_correlation(snapshot, built):
    _, _, spec = built
    cols = spec.metric_names + ["skor_kerentanan_sosial"]
    got = {r.indicator: r for r in X.describe(snapshot, cols).collect()}
    for _, g in golden("25%").iterrows():
        if g.indicator not in got:
            continue
        r = got[g.indicator]
        for mine, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert r[mine] == pytest.approx(g[theirs], abs=TOL), (g.indicator, mine)
    corr = {r.indicator: r for r in X.correlation_matrix(snapshot, spec.metric_names).collect()}
    for _, g in golden("indicator", "persentase_penduduk_miskin", exclude=("25%",)).iterrows():
        if g.indicator in corr:
            for m in spec.metric_names:
                assert corr[g.indicator][m] == pytest.approx(g[m], abs=1e-9)


def test_validation_all_pass(built):
    panel, _, spec = built
    checks = V.validation_checks(panel, spec).collect()
    assert len(checks) == 12 + len(spec.metrics) and {c.status for c in checks} == {"PASS"}


@pytest.fixture(scope="module")
def frame(built, regions, spark):
    panel, _, spec = built
    mf = M.model_frame(panel, spec, 2024, list(RG.CLUSTER_FEATURES), "nama_kabupaten_kota")
    mf = M.add_priority_action(M.add_tertile_level(mf, "skor_kerentanan_sosial"))
    labels = spark.createDataFrame([(int(c), int(r.cluster_id)) for c, r in regions.iterrows()],
                                   "kode_kabupaten_kota bigint, cluster_id int")
    return mf.join(labels, "kode_kabupaten_kota")


def test_slopes_levels_actions(frame, regions):
    for r in frame.collect():
        g = regions.loc[r.kode_kabupaten_kota]
        assert r.trend_slope == pytest.approx(g.tren_slope_poin_per_tahun, abs=TOL)
        assert (r.trend_label, r.vulnerability_level, r.priority_action, r.entity_type) == \
            (g.tren_kemiskinan, g.level_kerentanan, g.prioritas_aksi, g.tipe_administratif)


def test_cluster_statistics_with_published_labels(frame):
    feats = list(RG.CLUSTER_FEATURES)
    prof = {r.cluster_id: r for r in M.cluster_profiles(
        frame, 3, feats + ["skor_kerentanan_sosial"], "indeks_pembangunan_manusia", "persentase_penduduk_miskin").collect()}
    members = lambda cols: {k: "; ".join(sorted(v)) for k, v in M.group_members(frame, cols, "nama_kabupaten_kota").toPandas()
                            .groupby(cols)["member"].apply(list).items()}
    by_cluster = members(["cluster_id"])
    by_cluster = {k[0] if isinstance(k, tuple) else k: v for k, v in by_cluster.items()}
    for _, g in golden("anggota").iterrows():
        r = prof[g.cluster_id]
        assert (r.tier, r.archetype, r.n_entities, r.n_city, r.n_regency, by_cluster[g.cluster_id]) == \
            (g.cluster_vulnerability_tier, g.profil_ekonomi, g.jumlah_wilayah, g.jumlah_kota, g.jumlah_kabupaten, g.anggota)
        for c in feats + ["skor_kerentanan_sosial"]:
            assert r[f"mean_{c}"] == pytest.approx(g[f"mean_{c}"], abs=TOL)
    imp = {r.feature: r for r in M.anova(frame, feats).collect()}
    for _, g in golden("eta_squared").iterrows():
        r = imp[g.feature]
        assert (r.eta_squared, r.anova_f) == (pytest.approx(g.eta_squared, abs=TOL), pytest.approx(g.anova_f, abs=TOL))
        assert r.anova_p == pytest.approx(g.anova_p, abs=2e-6)
    labelled = M.attach_cluster_labels(frame, M.cluster_profiles(
        frame, 3, feats, "indeks_pembangunan_manusia", "persentase_penduduk_miskin"))
    cmp = {r.feature: r for r in M.two_group_stats(labelled, "archetype", "urban_industri", "rural_agraris",
                                                    feats).collect()}
    for _, g in golden("cohens_d").iterrows():
        if g.feature not in cmp:
            continue
        r = cmp[g.feature]
        assert r.mean_urban_industri == pytest.approx(g.mean_urban_industri, abs=TOL)
        assert r.mean_rural_agraris == pytest.approx(g.mean_rural_agraris, abs=TOL)
        assert r.cohens_d == pytest.approx(g.cohens_d, abs=TOL)
        assert r.welch_p == pytest.approx(g.welch_p, abs=2e-6)
    mat = {(r.vulnerability_level, r.trend_label): r for r in
           M.priority_matrix(frame).collect()}
    by_cell = members(["vulnerability_level", "trend_label"])
    gold = golden("dominant_cluster_id")
    assert len(mat) == len(gold)
    for _, g in gold.iterrows():
        r = mat[(g.level_kerentanan, g.tren_kemiskinan)]
        assert (r.priority_action, r.n_entities, r.dominant_cluster_id, by_cell[(g.level_kerentanan, g.tren_kemiskinan)]) == \
            (g.prioritas_aksi, g.jumlah_wilayah, g.dominant_cluster_id, g.wilayah)


def test_kmeans_not_worse_than_published_and_pca(frame, regions):
    feats = list(RG.CLUSTER_FEATURES)
    vec = ML.prepare(frame.drop("cluster_id"), feats)
    gold = golden("calinski_harabasz").set_index("k")
    for k in (2, 3):
        _, cost = ML.kmeans_best(vec, k)
        assert cost <= gold.loc[k, "inertia"] + 1e-3
    pcs = {r.kode_kabupaten_kota: r for r in ML.pca_scores(vec, 2).collect()}
    for code, g in regions.iterrows():
        assert pcs[code].pc1 == pytest.approx(g.pc1, abs=1e-4)
        assert pcs[code].pc2 == pytest.approx(g.pc2, abs=1e-4)
    # the published partition's quality measures
    z = ML.standardize(frame, feats)
    q = ML.quality_row(z, feats, "cluster_id").first()
    assert q.inertia == pytest.approx(gold.loc[3, "inertia"], abs=TOL)
    assert q.calinski_harabasz == pytest.approx(gold.loc[3, "calinski_harabasz"], abs=TOL)
    assert q.davies_bouldin == pytest.approx(gold.loc[3, "davies_bouldin"], abs=TOL)
    assert silhouette(z, feats, "cluster_id").first()[0] == pytest.approx(gold.loc[3, "silhouette"], abs=TOL)


def test_ward_agreement_with_published_labels(frame):
    feats = list(RG.CLUSTER_FEATURES)
    gold = golden("kmeans_ward_ari")
    got = ML.stability(ML.standardize(frame, feats), 3, "cluster_id", feats).first()["adjusted_rand"]
    assert got == pytest.approx(gold.kmeans_ward_ari.iloc[-1], abs=TOL)
