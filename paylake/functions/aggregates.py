"""Aggregate expressions with exact, order-independent results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money_sum(col, scale: str = "decimal(12,2)") -> Column:
    """Exact sum of a money column (summed as decimal, returned as double)."""
    return F.sum(_c(col).cast(scale)).cast("double")


def money_avg(col, scale: str = "decimal(12,2)") -> Column:
    """Average ignoring NULLs, from the exact decimal sum."""
    return money_sum(col, scale) / F.count(_c(col))


def cond_count(pred) -> Column:
    """``SUM(CASE WHEN pred THEN 1 END)``: NULL (not 0) when nothing matches."""
    return F.sum(F.when(_c(pred), F.lit(1))).cast("bigint")


def rate_pct(numerator, denominator) -> Column:
    """``ROUND(100.0 * num / den, 2)`` (decimal HALF_UP) as double; NULL if num is NULL."""
    return F.round(F.lit(100.0) * _c(numerator) / _c(denominator), 2).cast("double")
