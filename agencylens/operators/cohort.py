"""Entry cohorts: who entered a segment, and what happened afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.keys import key_parts
from ..functions.periods import period_distance
from .latest import latest_per_key

KEY = ("country", "channel", "branch", "folio")

# The segment change that defines the cohort, and the segments
# an entered entity is followed in.
FROM_SEGMENT, TO_SEGMENT = 4, 5
FOLLOWED_SEGMENTS = (5, 6, 15, 16, 28)


def entries_from_snapshots(
    snapshot: DataFrame,
    period: int,
    order_by: Sequence[str],
    tie_break: Sequence[str],
    country: int | None = 1,
    from_segment: int = FROM_SEGMENT,
    to_segment: int = TO_SEGMENT,
    first_period: int | None = None,
) -> DataFrame:
    """Entities whose record changed from one segment to the other into ``period``.

    Rows are filtered first and de-duplicated after, so a record in a third
    segment does not count as the period's last record. ``first_period``
    defaults to ``period - 2``, which reaches no earlier year; give the calendar's
    period two back (``calendar.find_period_around``) where that matters.
    """
    first = period - 2 if first_period is None else first_period
    wanted = F.col("period").between(first, period) & F.col("segment").isin(from_segment, to_segment)
    if country is not None:
        wanted = wanted & (F.col("country") == country)
    last = latest_per_key(snapshot.where(wanted), ("period", *KEY), order_by, tie_break)
    timeline = Window.partitionBy(*KEY).orderBy("period")
    moved = last.select(
        *KEY,
        "period",
        "segment",
        F.greatest(F.coalesce("arrears", F.lit(0)), F.lit(0)).alias("arrears_at_entry"),
        F.col("balance").alias("balance_at_entry"),
        F.lag("period").over(timeline).alias("prev_period"),
        F.lag("segment").over(timeline).alias("prev_segment"),
    )
    entered = (F.col("period") == period) & (F.col("segment") == to_segment) & (F.col("prev_segment") == from_segment)
    return moved.where(entered).drop("period")


def entries_from_events(
    changes: DataFrame, period: int, from_segment: int = FROM_SEGMENT, to_segment: int = TO_SEGMENT
) -> DataFrame:
    """Entities with a recorded segment change in ``period``."""
    chosen = (
        (F.col("segment") == from_segment) & (F.col("new_segment") == to_segment) & (F.col("period") == period)
    )
    return changes.where(chosen).select(
        *KEY,
        F.col("balance").alias("balance_at_entry"),
        F.col("arrears").alias("arrears_at_entry"),
        "arrears_accumulated",
    )


def cohort_arrears(
    snapshot: DataFrame,
    start_period: int,
    end_period: int,
    order_by: Sequence[str],
    tie_break: Sequence[str],
    segments: Sequence[int] = FOLLOWED_SEGMENTS,
) -> DataFrame:
    """Arrears of every entity whose last record of a period is in the segments.

    De-duplicated first, filtered by segment after: an entity whose last record
    is elsewhere is left out of that period.
    """
    ranged = snapshot.where(F.col("period").between(start_period, end_period))
    last = latest_per_key(ranged, ("period", *KEY), order_by, tie_break)
    return last.where(F.col("segment").isin(list(segments))).select("period", *KEY, "arrears", "segment")


def balance_at_close(balances: DataFrame, calendar: DataFrame, start_period: int, end_period: int) -> DataFrame:
    """Balances registered on each period's last day, summed per entity."""
    closing = (
        calendar.where(F.col("period").between(start_period, end_period))
        .groupBy("period")
        .agg(F.max("day").alias("registered_on"))
    )
    return (
        balances.where(F.col("principal_balance") >= 0)
        .join(closing, on="registered_on", how="inner")
        .groupBy("period", *KEY)
        .agg(
            F.sum("total_balance").alias("total_balance"),
            F.sum("principal_balance").alias("principal_balance"),
            F.max("arrears_accumulated").alias("arrears_accumulated"),
        )
    )


def balance_with_split_key(balances: DataFrame, start_period: int, end_period: int) -> DataFrame:
    """Balances keyed by ``"a-b-c-d"`` text, with the typed key parts."""
    return balances.where(F.col("period").between(start_period, end_period)).select(
        "period", *key_parts("entity_id", KEY), "principal_balance", "arrears_accumulated"
    )


def cohort_followup(
    arrears: DataFrame,
    entries: DataFrame,
    payments: DataFrame,
    balances: DataFrame,
    entry_period: int,
    distance: Column | None = None,
) -> DataFrame:
    """Period-by-period follow-up of the cohort with payments and balances.

    ``payments`` and ``balances`` have one row per (period, key). The distance
    in periods uses a 52-week year unless an expression is given.
    """
    cohort = arrears.join(
        entries.select(*KEY, "balance_at_entry", "arrears_at_entry"), on=list(KEY), how="inner"
    ).drop("segment")
    full_key = ["period", *KEY]
    followed = cohort.join(payments, on=full_key, how="left").join(balances, on=full_key, how="left")
    followed = followed.withColumn("entry_period", F.lit(entry_period))
    since = period_distance("period", "entry_period") if distance is None else distance
    return followed.withColumn("periods_since_entry", since)
