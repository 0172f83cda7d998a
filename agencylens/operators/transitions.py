"""Movements of an entity between its observed periods.

All windows share one specification (entity, ordered by observed period), so
Spark evaluates them in a single Window over a single sort. ``lag`` and ``lead``
step over periods in which the entity was not observed. A window partition is
one entity's de-duplicated periods, so its size is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.amounts import clamp_at_zero, filled_sum, flag

ENTITY = "entity_id"
PERIOD = "period"


def _timeline():
    return Window.partitionBy(ENTITY).orderBy(PERIOD)


def previous(column: str | Column) -> Column:
    """Value in the entity's previous observed period."""
    return F.lag(column, 1).over(_timeline())


def following(column: str | Column) -> Column:
    """Value in the entity's next observed period."""
    return F.lead(column, 1).over(_timeline())


def with_required_payment(df: DataFrame, clamped: bool = False) -> DataFrame:
    """Add ``required_payment``: what the previous period's record asks for.

    Plain form: NULL terms count 0 and the first period stays NULL. Clamped
    form: negative terms count 0 as well and the first period is 0.
    """
    if clamped:
        due = clamp_at_zero("last_payment") + clamp_at_zero("last_arrears_payment")
        return df.withColumn("required_payment", F.coalesce(previous(due), F.lit(0)))
    return df.withColumn("required_payment", previous(filled_sum("last_payment", "last_arrears_payment")))


def with_arrears_roll(df: DataFrame) -> DataFrame:
    """Add previous/next arrears, roll flags and known-neighbour flags.

    ``roll_forward``: one more than in the previous period. ``roll_backward``:
    one more than in the next period.
    """
    arrears = F.col("arrears")
    return df.withColumns(
        {"prev_arrears": previous("arrears"), "next_arrears": following("arrears")}
    ).withColumns(
        {
            "roll_forward": flag(arrears == F.col("prev_arrears") + 1),
            "roll_backward": flag(arrears == F.col("next_arrears") + 1),
            "with_prev_arrears": F.col("prev_arrears").isNotNull().cast("int"),
            "with_next_arrears": F.col("next_arrears").isNotNull().cast("int"),
        }
    )


def with_segment_transitions(df: DataFrame, segments: Sequence[int]) -> DataFrame:
    """Add previous/next segment and entering/leaving/being in the given segments.

    Entering and leaving need a known neighbour outside the segments.
    """
    inside = F.col("segment").isin(list(segments))
    came_from_outside = ~F.col("prev_segment").isin(list(segments))
    goes_outside = ~F.col("next_segment").isin(list(segments))
    return df.withColumns(
        {"prev_segment": previous("segment"), "next_segment": following("segment")}
    ).withColumns(
        {
            "enter_legal": flag(inside & came_from_outside),
            "out_legal": flag(inside & goes_outside),
            "in_legal": flag(inside),
            "with_prev_segment": F.col("prev_segment").isNotNull().cast("int"),
            "with_next_segment": F.col("next_segment").isNotNull().cast("int"),
        }
    )
