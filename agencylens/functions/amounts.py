"""Guards on money columns and ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def positive_sum(a: str | Column, b: str | Column) -> Column:
    """``a + b`` when positive, else 0; one NULL term makes the row count 0."""
    total = _col(a) + _col(b)
    return F.when(total > 0, total).otherwise(0)


def clamp_at_zero(x: str | Column) -> Column:
    """NULL and negative amounts become 0."""
    return F.greatest(F.coalesce(_col(x), F.lit(0)), F.lit(0))


def filled_sum(a: str | Column, b: str | Column) -> Column:
    """``a + b`` with each NULL term counted as 0."""
    return F.coalesce(_col(a), F.lit(0)) + F.coalesce(_col(b), F.lit(0))


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def ratio_or_null(numerator: str | Column, denominator: str | Column) -> Column:
    """Double quotient where the denominator is positive, else NULL."""
    n, d = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(d > 0, n / d)


def ratio_or_zero(numerator: str | Column, denominator: str | Column) -> Column:
    """Double quotient where the denominator is positive, else 0."""
    n, d = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))
