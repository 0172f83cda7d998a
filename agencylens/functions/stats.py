"""Regression slope as an aggregate expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ols_slope(y: str, t: str = "t", null_handling: str = "reference") -> Column:
    """Least-squares slope of ``y`` over ``t`` within the group.

    ``reference``: the count leaves out rows whose ``y`` is NULL but the sums
    over ``t`` keep them, so a gap in ``y`` biases the slope.
    ``pairwise``: rows with a NULL are left out of every sum (``regr_slope``).
    NULL when the denominator is 0.
    """
    if null_handling == "pairwise":
        return F.regr_slope(F.col(y).cast("double"), F.col(t).cast("double"))
    if null_handling != "reference":
        raise ValueError(f"unknown null_handling {null_handling!r}")
    at, obs = F.col(t).cast("double"), F.col(y).cast("double")
    n = F.count(F.col(y)).cast("double")
    spread = n * F.sum(at * at) - F.sum(at) * F.sum(at)
    return F.when(spread != 0, (n * F.sum(at * obs) - F.sum(at) * F.sum(obs)) / spread)
