"""Calendar dimension and period look-ups."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.periods import date_to_int


def day_calendar(first_and_last: DataFrame, period_of_day: Column) -> DataFrame:
    """One row per day between ``first_day`` and ``last_day`` of a one-row frame.

    ``period_of_day`` is an expression over the column ``day``. The result grows
    with the length of the date range, never with the number of facts.
    """
    days = first_and_last.select(F.explode(F.sequence("first_day", "last_day")).alias("day"))
    return days.select("day", period_of_day.cast("int").alias("period"))


def period_limits(calendar: DataFrame) -> DataFrame:
    """First and last day of each period, with a dense index over the periods."""
    limits = calendar.groupBy("period").agg(F.min("day").alias("start_date"), F.max("day").alias("end_date"))
    # the calendar has one row per period here: a few thousand at most
    return limits.withColumn("period_index", F.row_number().over(Window.orderBy("period")))


def period_limits_of(calendar: DataFrame, period: int) -> DataFrame:
    """Start and end of one period: one row, or no row when it is unknown."""
    chosen = calendar.where(F.col("period") == period)
    return chosen.groupBy("period").agg(F.min("day").alias("start_date"), F.max("day").alias("end_date"))


def period_around(calendar: DataFrame, pivot: int, n: int, forward: bool = False) -> DataFrame:
    """The n-th period before (or after) the pivot as a one-row frame.

    Fewer than n periods on that side: the farthest one there is. None at all:
    NULL. Min/max over the n nearest periods does not depend on row order.
    """
    period = F.col("period")
    side = period > pivot if forward else period < pivot
    nearest = calendar.where(side).select("period").distinct().orderBy(period.asc() if forward else period.desc()).limit(n)
    farthest = F.max("period") if forward else F.min("period")
    return nearest.agg(farthest.alias("period"))


def find_period_around(calendar: DataFrame, pivot: int, n: int, forward: bool = False) -> int | None:
    """Value of :func:`period_around` on the driver: one number."""
    return period_around(calendar, pivot, n, forward).first()["period"]


def find_period_limits(calendar: DataFrame, period: int) -> tuple[datetime.date | None, datetime.date | None]:
    """Start and end of a period on the driver, ``(None, None)`` when unknown."""
    row = period_limits_of(calendar, period).first()
    return (None, None) if row is None else (row["start_date"], row["end_date"])


def dated_from(df: DataFrame, calendar: DataFrame, start_period: int, yyyymmdd: str) -> DataFrame:
    """Rows dated on or after the period's first day, none if the period is unknown.

    The first day is looked up on the driver, one number, so that the bound is a
    plain comparison with the source's own column and reaches its scan.
    """
    first_day, _ = find_period_limits(calendar, start_period)
    return df.where(F.lit(False) if first_day is None else F.col(yyyymmdd) >= int(first_day.strftime("%Y%m%d")))


def with_period_of_date(df: DataFrame, limits: DataFrame, yyyymmdd: str, period: str = "period") -> DataFrame:
    """Add the period whose start..end contains the ``YYYYMMDD`` number, else NULL.

    The limits are exploded to days, as numbers like the facts have them: the
    range join becomes an equi-join and no fact row is parsed into a date; a
    number that is no date matches no day. The planner broadcasts the days while they are below its size
    threshold, which a calendar is, and has the sort-merge join beyond it.
    """
    days = limits.select(F.explode(F.sequence("start_date", "end_date")).alias("_day"), F.col("period").alias(period))
    numbered = days.withColumn("_day", date_to_int("_day"))
    return df.join(numbered, on=F.col(yyyymmdd) == F.col("_day"), how="left").drop("_day")
