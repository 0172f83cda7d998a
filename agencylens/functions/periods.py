"""Periods (``YYYYWW`` integers), epoch milliseconds and dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: a year counts as 52 weeks in the plain period distance.
WEEKS_PER_YEAR = 52


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_from_parts(year: str | Column, week: str | Column) -> Column:
    """``concat(year, lpad(week, 2, '0'))`` as int; a 3-digit week is cut to 2 digits."""
    week_text = F.lpad(_col(week).cast("string"), 2, "0")
    return F.concat(_col(year).cast("string"), week_text).cast("int")


def epoch_ms_to_date(ms: str | Column) -> Column:
    """Date (session time zone) of an epoch-millisecond value."""
    return F.timestamp_millis(_col(ms)).cast("date")


def int_to_date(yyyymmdd: str | Column) -> Column:
    """Date of a ``YYYYMMDD`` number, NULL when it is no date."""
    return F.try_to_date(_col(yyyymmdd).cast("string"), "yyyyMMdd")


def date_to_int(date: str | Column) -> Column:
    """``YYYYMMDD`` number of a date."""
    day = _col(date)
    return F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)


def tenure_days(start_ms: str | Column, end_ms: str | Column) -> Column:
    """Days from start to end, 0 when either end is missing."""
    start, end = _col(start_ms), _col(end_ms)
    known = start.isNotNull() & end.isNotNull()
    return F.when(known, F.datediff(epoch_ms_to_date(end), epoch_ms_to_date(start))).otherwise(0)


def minutes_between(start_ms: str | Column, end_ms: str | Column) -> Column:
    """Duration in minutes between two epoch-millisecond values."""
    return (_col(end_ms) - _col(start_ms)) / F.lit(60_000)


def period_distance(period: str | Column, origin: str | Column) -> Column:
    """Weeks between two periods on a fixed 52-week year.

    Off by one per 53-week year crossed; subtract the ``period_index`` of the
    calendar dimension where the true distance matters.
    """

    def ordinal(p: Column) -> Column:
        return F.floor(p / 100).cast("int") * WEEKS_PER_YEAR + p % 100

    return ordinal(_col(period)) - ordinal(_col(origin))
