"""Guarded, exact ratios.

Operands are brought to ``decimal(24,2)`` first: wide enough for sums over 10^21
cents, and narrow enough that the quotient keeps at least 14 decimals before it is
rounded (``decimal(38,2)`` operands would leave six).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(24,2)"


def quotient(part: Column, whole: Column) -> Column:
    """``part / whole`` unrounded; NULL where ``whole`` is 0."""
    return part.cast(_WIDE) / F.nullif(whole.cast(_WIDE), F.lit(0).cast(_WIDE))


def percent(part: Column, whole: Column) -> Column:
    return F.round(quotient(part, whole) * F.lit(100), 2)


def rate_or_zero(part: Column, whole: Column) -> Column:
    """Percentage rounded to 2 where ``whole`` is positive, else 0."""
    return F.when(whole > 0, percent(part, whole)).otherwise(F.lit(0))


def average_or_zero(total: Column, n: Column) -> Column:
    return F.when(n > 0, F.round(quotient(total, n), 2)).otherwise(F.lit(0))
