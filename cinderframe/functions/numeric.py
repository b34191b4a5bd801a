"""Exact-decimal rounding and safe division.

Rounding rule: a value is cast to ``decimal(28,10)`` and then rounded half away from zero
(``HALF_UP``), as a relational ``ROUND(x::numeric, n)`` does.  Rounding the binary double
directly would disagree on ties (``round(1.005, 2)``), and the 10-decimal cast absorbs
representation error and summation-order noise.  Results are returned as doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

WORK_DECIMAL = "decimal(28,10)"


def as_decimal(c: Column | str) -> Column:
    """Cast to the working decimal type (NaN/inf become NULL, never raise)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(WORK_DECIMAL)


def round_half_up(c: Column | str, scale: int) -> Column:
    """``ROUND(x::numeric, scale)`` returned as double."""
    return F.round(as_decimal(c), scale).cast("double")


def dec(v) -> Column:
    """An exact decimal literal (``F.lit(0.1)`` would be a binary double)."""
    return F.lit(Decimal(str(v)))


def safe_div(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of an error on a zero divisor (ANSI mode)."""
    return num / F.nullif(den, F.lit(0))
