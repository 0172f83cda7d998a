"""Entry cohort from detection to follow-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ..operators.cohort import FOLLOWED_SEGMENTS, KEY, cohort_arrears, cohort_followup
from ..operators.ledger import payments_by_period, with_cumulative_payment
from ..operators.population import restrict_to


def entry_cohort(
    snapshot: DataFrame,
    entries: DataFrame,
    payments: DataFrame,
    balances: DataFrame,
    entry_period: int,
    end_period: int,
    order_by: Sequence[str],
    tie_break: Sequence[str],
    segments: Sequence[int] = FOLLOWED_SEGMENTS,
    distance: Column | None = None,
) -> DataFrame:
    """Follow the entered entities from ``entry_period`` to ``end_period``.

    ``entries`` comes from snapshots or from change events, ``balances`` from
    closing-day balances or from the flattened-key source. Snapshots and payments
    are restricted to the entered entities before they are de-duplicated or
    summed, which goes by entity, so the result is the same; restrict the
    balances' source likewise where it is aggregated.
    """
    entered = entries.select(*KEY)
    arrears = cohort_arrears(restrict_to(snapshot, entered, list(KEY)), entry_period, end_period, order_by, tie_break, segments)
    paid = with_cumulative_payment(payments_by_period(restrict_to(payments, entered, list(KEY)), entry_period, end_period, KEY), KEY)
    return cohort_followup(arrears, entries, paid, balances, entry_period, distance)
