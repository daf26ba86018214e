"""Numeric helpers shared by every operator.

``round_half_even`` is ``rint(x * 10^d) / 10^d``: the same algorithm as numpy/pandas
``round`` (ties to even on the binary value), built from IEEE operations so that any
engine computing it gets the same bits. Spark's ``round``/``bround`` instead round the
shortest decimal string, which differs on values such as 328354.56625.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column | str, digits: int = 4) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def sql_round(expr: str, digits: int = 4) -> str:
    """SQL (DuckDB) twin of :func:`round_half_even`."""
    return f"round_even(CAST({expr} AS DOUBLE) * {10 ** digits}e0, 0) / {10 ** digits}e0"
