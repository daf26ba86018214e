"""Tail probabilities of the F and Student-t distributions, as Column expressions.

The regularised incomplete beta function is evaluated with its continued fraction (modified Lentz): one
``aggregate`` over half-steps whose state is (c, d, h, done). The number of half-steps follows
from the parameters; a fraction that has not converged by then gives null rather than a
wrong value. No Python worker takes part. Degrees of freedom beyond MAX_DF count as MAX_DF, which
changes a tail by about one part in MAX_DF.

``f_sf``, ``t_two_sided`` and ``betainc_regularized`` are the same for single Python numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DF = 1e7
_TINY, _EPS = 1e-300, 1e-15


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _stirling(x: Column) -> Column:
    """What Stirling's formula lacks of log gamma, for x of 8 or more."""
    y = 1.0 / (x * x)
    return (1.0 / 12 - y * (1.0 / 360 - y * (1.0 / 1260 - y * (1.0 / 1680 - y / 1188)))) / x


def log_gamma(x: Column) -> Column:
    """log gamma of x > 0: eight steps up, then Stirling's formula."""
    product = x
    for i in range(1, 8):
        product = product * (x + float(i))
    z = x + 8.0
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + _stirling(z) - F.log(product)


def _log_beta(s: Column) -> Column:
    """log B(a, b) of the struct's a and b; where the larger is large, without subtracting large numbers."""
    def of(t):
        big, small = t["big"], t["small"]
        rise = (big - 0.5) * F.log1p(small / big) + small * F.log(big + small) - small + _stirling(big + small) - _stirling(big)
        return log_gamma(small) - F.when(big >= 8.0, rise).otherwise(log_gamma(big + small) - log_gamma(big))
    return _let(F.struct(F.greatest(s["a"], s["b"]).alias("big"), F.least(s["a"], s["b"]).alias("small")), of)


def _guarded(x: Column) -> Column:
    return F.when(F.abs(x) < _TINY, F.lit(_TINY)).otherwise(x)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function; null if it has not converged."""
    steps = F.sequence(F.lit(1), (200 + 20 * F.sqrt(F.greatest(a, b))).cast("int"))

    def half(state, j):
        m = F.floor(j / 2).cast("double")
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        # the first factor belongs to the start: half-step 1 is the first odd one, with m = 0
        def moved(factor):
            d = 1.0 / _guarded(1.0 + factor * state["d"])
            c = _guarded(1.0 + factor / state["c"])
            return _let(F.struct(c.alias("c"), d.alias("d")), lambda t: F.struct(
                t["c"].alias("c"), t["d"].alias("d"), (state["h"] * t["c"] * t["d"]).alias("h"), (F.abs(t["c"] * t["d"] - 1.0) < _EPS).alias("done")))
        return F.when(state["done"], state).otherwise(_let(F.when(j % 2 == 1, odd).otherwise(even), moved))

    # 1 + f1 / (1 + f2 / (1 + ...)) is h; the function has it in its denominator
    start = F.struct(F.lit(1.0).alias("c"), F.lit(0.0).alias("d"), F.lit(1.0).alias("h"), F.lit(False).alias("done"))
    return F.aggregate(steps, start, half, lambda s: F.when(s["done"], 1.0 / s["h"]))


def incomplete_beta(a: Column, b: Column, x: Column, y: Column) -> Column:
    """Regularised incomplete beta I_x(a, b), with y = 1 - x; null outside its domain."""
    def of(s):
        swap = s["x"] >= (s["a"] + 1.0) / (s["a"] + s["b"] + 2.0)
        turned = F.struct(F.when(swap, s["b"]).otherwise(s["a"]).alias("a"), F.when(swap, s["a"]).otherwise(s["b"]).alias("b"),
                          F.when(swap, s["y"]).otherwise(s["x"]).alias("x"), F.when(swap, s["x"]).otherwise(s["y"]).alias("y"), swap.alias("swap"))

        def value(t):
            part = F.exp(t["a"] * F.log(t["x"]) + t["b"] * F.log(t["y"]) - _log_beta(t)) * _fraction(t["a"], t["b"], t["x"]) / t["a"]
            return F.when(t["swap"], 1.0 - part).otherwise(part)
        return (F.when((s["a"] > 0) & (s["b"] > 0) & s["x"].isNotNull() & s["y"].isNotNull() & ~F.isnan(s["x"]), F.when(s["x"] <= 0, F.lit(0.0))
                       .when(s["y"] <= 0, F.lit(1.0)).otherwise(_let(turned, value))))
    return _let(F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"), x.cast("double").alias("x"), y.cast("double").alias("y")), of)


def anova_p(f: Column, d1: Column, d2: Column) -> Column:
    """P(F > f) for F(d1, d2)."""
    f, d1, d2 = f.cast("double"), d1.cast("double"), F.least(d2.cast("double"), F.lit(MAX_DF))
    ok = f.isNotNull() & ~F.isnan(f) & (d1 > 0) & (d2 > 0)
    return F.when(ok, F.when(f == float("inf"), F.lit(0.0)).when(f <= 0, F.lit(1.0)).otherwise(
        incomplete_beta(d2 / 2.0, d1 / 2.0, F.try_divide(d2, d2 + d1 * f), F.try_divide(d1 * f, d2 + d1 * f))))


def welch_p(t: Column, df: Column) -> Column:
    """P(|T| > |t|) for Student t with (possibly fractional) df."""
    t, df = t.cast("double"), F.least(df.cast("double"), F.lit(MAX_DF))
    ok = t.isNotNull() & ~F.isnan(t) & (df > 0)
    return F.when(ok, F.when(F.abs(t) == float("inf"), F.lit(0.0)).otherwise(
        incomplete_beta(df / 2.0, F.lit(0.5), F.try_divide(df, df + t * t), F.try_divide(t * t, df + t * t))))


def _math():
    import math
    LARGE_DF = 1e7

    def betacf(a, b, x):
        tiny, eps = 1e-300, 1e-15
        qab, qap, qam = a + b, a + 1.0, a - 1.0
        c, d = 1.0, 1.0 - qab * x / qap
        d = 1.0 / (tiny if abs(d) < tiny else d)
        h = d
        for m in range(1, 100_000):
            m2 = 2 * m
            for aa in (m * (b - m) * x / ((qam + m2) * (a + m2)),
                       -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))):
                d = 1.0 + aa * d
                d = 1.0 / (tiny if abs(d) < tiny else d)
                c = 1.0 + aa / c
                c = tiny if abs(c) < tiny else c
                h *= d * c
            if abs(d * c - 1.0) < eps:
                return h
        return float("nan")  # not converged: no value rather than a wrong one

    def betainc(a, b, x):
        """Regularised incomplete beta I_x(a, b)."""
        if any(v is None or math.isnan(v) for v in (a, b, x)) or a <= 0 or b <= 0:
            return float("nan")
        if x <= 0.0:
            return 0.0
        if x >= 1.0:
            return 1.0
        lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
        if x < (a + 1.0) / (a + b + 2.0):
            return math.exp(lbt) * betacf(a, b, x) / a
        return 1.0 - math.exp(lbt) * betacf(b, a, 1.0 - x) / b

    def gamma_q(a, x):
        """Regularised upper incomplete gamma Q(a, x)."""
        if x <= 0.0:
            return 1.0
        scale = math.exp(a * math.log(x) - x - math.lgamma(a))
        if x < a + 1.0:  # series of the lower part
            term = total = 1.0 / a
            n = a
            while abs(term) > abs(total) * 1e-16:
                n += 1.0
                term *= x / n
                total += term
            return 1.0 - total * scale
        tiny = 1e-300
        b = x + 1.0 - a
        c, d = 1.0 / tiny, 1.0 / b
        h = d
        for i in range(1, 100_000):
            step = -i * (i - a)
            b += 2.0
            d = step * d + b
            d = 1.0 / (tiny if abs(d) < tiny else d)
            c = b + step / c
            c = tiny if abs(c) < tiny else c
            h *= d * c
            if abs(d * c - 1.0) < 1e-15:
                return scale * h
        return float("nan")

    def f_sf(f, d1, d2):
        """P(F > f) for F(d1, d2)."""
        if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
            return float("nan")
        if math.isinf(f):
            return 0.0
        if f <= 0:
            return 1.0
        if d2 > LARGE_DF:  # d1 F is then chi-squared with d1 degrees of freedom, to 1 part in d2
            return gamma_q(d1 / 2.0, d1 * f / 2.0)
        return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))

    def t_two_sided(t, df):
        """P(|T| > |t|) for Student t with (possibly fractional) df."""
        if t is None or math.isnan(t) or df is None or math.isnan(df) or df <= 0:
            return float("nan")
        if math.isinf(t):
            return 0.0
        if df > LARGE_DF:  # normal, to 1 part in df
            return math.erfc(abs(t) / math.sqrt(2.0))
        return betainc(df / 2.0, 0.5, df / (df + t * t))

    return betainc, f_sf, t_two_sided


betainc_regularized, f_sf, t_two_sided = _math()
