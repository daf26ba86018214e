"""Ready-made configuration for the regional poverty panel the engine was modelled on:
district/city code × year, five indicator sources (one CSV per indicator with an ``id``,
province and district columns, the indicator and its unit). ``build_panel`` runs the
scrub → integrate → period filter → features path on such files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from kestrel.operators import clean as C
from kestrel.operators import features as FT
from kestrel.operators import joins as J
from kestrel.operators import panel as P
from kestrel.sources.files import scan_csv
from kestrel.spec import CONTEXT_ONLY, HIGH_IS_RISKY, LOW_IS_RISKY, MetricSpec, PanelSpec

# Column names, labels and units of the indicator sources.
ENTITY, PERIOD, ENTITY_NAME = "kode_kabupaten_kota", "tahun", "nama_kabupaten_kota"
PROVINCE_CODE, PROVINCE_NAME = "kode_provinsi", "nama_provinsi"
DIMS = (PROVINCE_CODE, PROVINCE_NAME, ENTITY, ENTITY_NAME)
SOURCES = (  # (source name, indicator column, label, unit, risk direction)
    ("raw_garis_kemiskinan", "garis_kemiskinan", "Garis kemiskinan", "rupiah/kapita/bulan", CONTEXT_ONLY),
    ("raw_persentase_miskin", "persentase_penduduk_miskin", "Persentase penduduk miskin", "persen", HIGH_IS_RISKY),
    ("raw_keparahan_kemiskinan", "indeks_keparahan_kemiskinan", "Indeks keparahan kemiskinan", "indeks", HIGH_IS_RISKY),
    ("raw_ipm_sp2010", "indeks_pembangunan_manusia", "Indeks pembangunan manusia", "indeks", LOW_IS_RISKY),
    ("raw_pengangguran_terbuka", "tingkat_pengangguran_terbuka", "Tingkat pengangguran terbuka", "persen", HIGH_IS_RISKY),
)
DOMAINS = {  # validation domain per indicator: (low, high, low_strict)
    "garis_kemiskinan": (0.0, None, True),
    "persentase_penduduk_miskin": (0.0, 100.0, False),
    "indeks_keparahan_kemiskinan": (0.0, None, False),
    "indeks_pembangunan_manusia": (0.0, 100.0, False),
    "tingkat_pengangguran_terbuka": (0.0, 100.0, False),
}
CLUSTER_FEATURES = ("persentase_penduduk_miskin", "indeks_keparahan_kemiskinan",
                    "indeks_pembangunan_manusia", "tingkat_pengangguran_terbuka")
START, END = 2010, 2024


def metric_specs(available: list[str] | None = None) -> tuple[MetricSpec, ...]:
    out = []
    for _, col, label, unit, risk in SOURCES:
        if available is not None and col not in available:
            continue
        lo, hi, strict = DOMAINS[col]
        out.append(MetricSpec(col, label, unit, risk, low=lo, high=hi, low_strict=strict))
    return tuple(out)


def panel_spec(available: list[str] | None = None) -> PanelSpec:
    return PanelSpec(entity=ENTITY, period=PERIOD, metrics=metric_specs(available), entity_name=ENTITY_NAME,
                     dims=DIMS, trend_metric="persentase_penduduk_miskin", score_col="skor_kerentanan_sosial",
                     expected_entities=27, period_start=START, period_end=END)


def dataset_spec(name: str, metric: str) -> C.DatasetSpec:
    return C.DatasetSpec(
        name, metric=metric, entity=ENTITY, period=PERIOD, entity_name=ENTITY_NAME, id_col="id", order_col="ingest_order",
        dims=(PROVINCE_CODE, PROVINCE_NAME), dim_filter=(PROVINCE_NAME, "JAWA BARAT"),
        defaults=((PROVINCE_CODE, 32), (PROVINCE_NAME, "JAWA BARAT")),
        int_cols=("id", PROVINCE_CODE), name_cols=(PROVINCE_NAME, "satuan"), extra_cols=("satuan",))


def build_panel(spark: SparkSession, paths: dict[str, str], start: int = START, end: int = END):
    """Scrub each available source, integrate, filter the period, add features.

    ``paths`` maps source names to CSV paths; sources without a file are skipped (their
    indicator is then absent from the spec). Returns (scored panel, profiles, spec)."""
    cleaned, profiles, dim_frames, present = [], [], [], []
    for name, metric, *_ in SOURCES:
        if name not in paths:
            continue
        out, prof = C.clean_dataset(scan_csv(spark, paths[name], ingest_order="ingest_order"), dataset_spec(name, metric))
        cleaned.append(out.select(ENTITY, PERIOD, metric, f"{metric}_was_imputed"))
        dim_frames.append(out.select(*DIMS))
        profiles.append(prof)
        present.append(metric)
    spec = panel_spec(present)
    panel = J.union_aggregate(cleaned, [ENTITY, PERIOD])
    dims = J.resolve_dimensions(dim_frames, ENTITY, ENTITY_NAME, list(DIMS))
    panel = panel.join(dims, ENTITY, "left")
    panel = P.filter_period(panel, spec, start, end)
    scored = FT.add_features(panel, spec, materialize=True)
    profile = reduce(DataFrame.unionByName, profiles)
    return scored, profile, spec


def rename_features(df: DataFrame) -> DataFrame:
    """Original output names of the derived columns."""
    # Output names.
    mapping = {"priority_rank": "peringkat_prioritas_intervensi", "priority_bucket": "prioritas_intervensi",
               "trend_direction": "arah_tren_kemiskinan", "n_score_components": "jumlah_komponen_skor_kerentanan",
               "n_imputed": "jumlah_indikator_diimputasi", "n_available": "jumlah_indikator_tersedia",
               "persentase_penduduk_miskin_rolling_3": "persentase_miskin_rolling_3y"}
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
