"""Panel specification: which columns are entity/period/metrics and how metrics behave.

A panel is a table keyed by (entity, period) with one column per metric. The spec is
driver-side configuration only; every operator takes it and returns a lazy DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass, field

HIGH_IS_RISKY = "high_is_risky"
LOW_IS_RISKY = "low_is_risky"
CONTEXT_ONLY = "context_only"


@dataclass(frozen=True)
class MetricSpec:
    name: str
    label: str = ""
    unit: str = ""
    risk: str = HIGH_IS_RISKY
    zero_is_missing: bool = True
    # Domain rule for validation: (low, high) bounds, None = open; low_strict means "> low".
    low: float | None = None
    high: float | None = None
    low_strict: bool = False

    @property
    def is_risk(self) -> bool:
        return self.risk != CONTEXT_ONLY


# ---------------------------------------------------------------------------
# Label vocabulary and thresholds whose text must equal the original
# pipeline's outputs. Kept together, in natural order.
# ---------------------------------------------------------------------------
TREND_UP = "naik"
TREND_DOWN = "turun"
TREND_FLAT = "stabil"
TREND_NO_BASE = "belum_ada_pembanding"
TREND_DELTA_THRESHOLD = 0.1

SLOPE_WORSE = "memburuk"
SLOPE_BETTER = "membaik"
SLOPE_FLAT = "stabil"
SLOPE_UNKNOWN = "tidak_diketahui"
SLOPE_TOLERANCE = 0.05
SLOPE_WINDOW = 6

PRIORITY_BUCKETS = (  # (upper edge of percent rank, label); lowest edge 0 is included
    (0.2, "sangat_tinggi"),
    (0.5, "tinggi"),
    (0.8, "sedang"),
    (1.0, "rendah"),
)

LEVEL_LABELS = ("rendah", "sedang", "tinggi")  # low, middle, high tertile of the score
LEVEL_ORDER = ("tinggi", "sedang", "rendah")
TREND_ORDER = ("memburuk", "stabil", "membaik", "tidak_diketahui")

PRIORITY_ACTION = {
    ("tinggi", "memburuk"): "prioritas_segera",
    ("tinggi", "stabil"): "intervensi_intensif",
    ("tinggi", "membaik"): "intervensi_intensif",
    ("tinggi", "tidak_diketahui"): "intervensi_intensif",
    ("sedang", "memburuk"): "peringatan_dini",
    ("sedang", "stabil"): "pemantauan",
    ("sedang", "membaik"): "pemantauan",
    ("sedang", "tidak_diketahui"): "pemantauan",
    ("rendah", "memburuk"): "pantau",
    ("rendah", "stabil"): "rutin",
    ("rendah", "membaik"): "rutin",
    ("rendah", "tidak_diketahui"): "rutin",
}
PRIORITY_DEFAULT = "rutin"
URGENT_ACTION = "prioritas_segera"

TIER_NAMES_K3 = ("kerentanan_tinggi", "kerentanan_menengah", "kerentanan_rendah")
TIER_TOP = "kerentanan_tertinggi"
TIER_BOTTOM = "kerentanan_terendah"
TIER_MIDDLE_PREFIX = "kerentanan_menengah_"

ARCHETYPE_URBAN = "urban_industri"
ARCHETYPE_RURAL = "rural_agraris"
ARCHETYPE_MIXED = "campuran"
ARCHETYPE_TERTILES = (0.33, 0.67)

TYPE_CITY = "kota"
TYPE_REGENCY = "kabupaten"
CITY_PREFIX = "KOTA"

GROUP_MOST = "paling_rentan"
GROUP_LEAST = "paling_tidak_rentan"

DEFAULT_PROVINCE_CODE = 32
DEFAULT_PROVINCE_NAME = "JAWA BARAT"
MISSING_TOKENS = ("", "nan", "none", "null", "-")
CSV_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                   "NULL", "NaN", "None", "n/a", "nan", "null")

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class PanelSpec:
    entity: str
    period: str
    metrics: tuple[MetricSpec, ...]
    entity_name: str | None = None
    dims: tuple[str, ...] = ()
    trend_metric: str | None = None
    rolling_window: int = 3
    score_col: str = "score"
    score_digits: int = 4
    expected_entities: int | None = None
    period_start: int | None = None
    period_end: int | None = None
    extra: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.period]

    @property
    def metric_names(self) -> list[str]:
        return [m.name for m in self.metrics]

    @property
    def risk_metrics(self) -> list[MetricSpec]:
        return [m for m in self.metrics if m.is_risk]

    def metric(self, name: str) -> MetricSpec:
        for m in self.metrics:
            if m.name == name:
                return m
        raise KeyError(name)

    @property
    def trend(self) -> str:
        return self.trend_metric or self.risk_metrics[0].name

    def period_bound(self) -> int | None:
        """Upper bound on distinct periods, known when the analysis period is fixed."""
        if self.period_start is None or self.period_end is None:
            return None
        return int(self.period_end) - int(self.period_start) + 1
