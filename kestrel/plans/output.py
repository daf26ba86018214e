"""Canonical output shape for registered queries (so two engines can be compared).

Doubles are rounded with ``rint(x * 10^d) / 10^d`` (see ``kestrel.functions.numeric``):
plain IEEE arithmetic, so both engines produce the same bits. Integral columns are
widened to bigint. Applied only at the very end of a query plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from kestrel.functions.numeric import round_half_even, sql_round
from pyspark.sql.types import ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType

DIGITS = 4


def canonical(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType, DecimalType)):
            c = round_half_even(c.cast("double"), digits)
        elif isinstance(f.dataType, (ByteType, ShortType, IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, LongType):
            pass
        cols.append(c.alias(f.name))
    return df.select(*cols)


def r(expr: str, digits: int = DIGITS) -> str:
    """SQL twin of :func:`canonical` for one double expression."""
    return sql_round(expr, digits)
