"""Column helpers for the null, division and rounding rules of the indicator maths.

* Inputs hold NULL, never NaN or an infinity (``finite_or_null`` at ingest).
* A zero divisor yields NULL (``safe_div``), as ANSI mode would raise.
* Indicator rounding is half-to-even on the binary value: ``rint(x*10^d)/10^d``
  (``rnd``).  Screen rounding is half-up on the decimal value (``dec_round``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c: Column | str, digits: int) -> Column:
    """Half-to-even rounding on the binary double, as numpy does; ``-0.0`` becomes ``0.0``."""
    scale = float(10 ** digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def safe_div(num: Column | str, den: Column | str) -> Column:
    """``num / den`` with NULL for a zero or NULL divisor."""
    return F.try_divide(col(num), col(den))


def dec_round(c: Column | str, digits: int) -> Column:
    """Half-up rounding of the decimal value (SQL ``ROUND(CAST(x AS NUMERIC), d)``), as double."""
    return F.round(col(c).cast("decimal(38,12)"), digits).cast("double")


def finite_or_null(c: Column | str) -> Column:
    """NaN and infinities are no observations: NULL (Spark would order NaN above every number)."""
    c = col(c)
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
