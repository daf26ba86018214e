"""Tails of F and Student's t as Columns against the same fractions in plain Python and closed forms."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kestrel.functions import distributions as D


def test_tails_equal_plain_python(spark):
    rng = random.Random(1)
    rows = [(rng.choice([0.01, 0.3, 1.0, 3.758, 20.0, 500.0]), float(rng.choice([1, 2, 3, 7, 40])), float(rng.choice([1, 2, 5.5, 24, 300, 1e5, 1e6]))) for _ in range(60)]
    out = spark.createDataFrame(rows, "f double, a double, b double").select(
        "*", D.anova_p(F.col("f"), F.col("a"), F.col("b")).alias("p"), D.welch_p(F.col("f"), F.col("b")).alias("t")).collect()
    for r in out:
        assert r.p == pytest.approx(D.f_sf(r.f, r.a, r.b), rel=1e-8, abs=1e-13)
        assert r.t == pytest.approx(D.t_two_sided(r.f, r.b), rel=1e-8, abs=1e-13)


def test_tails_outside_their_domain(spark):
    rows = [(0.0, 2.0, 3.0), (None, 2.0, 3.0), (math.nan, 2.0, 3.0), (math.inf, 2.0, 3.0), (1.0, 0.0, 3.0), (1.0, 2.0, 0.0), (3.0, 2.0, 1e12)]
    out = spark.createDataFrame(rows, "f double, a double, b double").select(
        D.anova_p(F.col("f"), F.col("a"), F.col("b")).alias("p"), D.welch_p(F.col("f"), F.col("b")).alias("t")).collect()
    assert [r.p for r in out[:6]] == [1.0, None, None, 0.0, None, None]
    assert out[6].p == pytest.approx(math.exp(-3.0), rel=1e-5)  # chi-squared with 2 degrees of freedom
    assert [r.t for r in out[:4]] == [pytest.approx(1.0), None, None, 0.0]
    assert out[5].t is None and out[6].t == pytest.approx(math.erfc(3 / math.sqrt(2)), rel=1e-5)


def test_log_gamma(spark):
    xs = [0.01, 0.5, 1.0, 2.5, 8.0, 123.4, 1e6]
    out = spark.createDataFrame([(x,) for x in xs], "x double").select("x", D.log_gamma(F.col("x")).alias("g")).collect()
    for r in out:
        assert r.g == pytest.approx(math.lgamma(r.x), rel=1e-12, abs=1e-12)
