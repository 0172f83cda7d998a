"""Agency history from ledger rows and cash payments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.ledger import payment_flow_and_close
from ..operators.rollup import agency_rollup, weekly_agency_totals


def agency_history_rollup(
    ledger: DataFrame, cash: DataFrame, start_period: int, order_by: Sequence[str], tie_break: Sequence[str]
) -> DataFrame:
    """Weekly totals of ledger and payment flow from ``start_period`` on, rolled up to (agency, segment)."""
    flow = payment_flow_and_close(cash, order_by, tie_break, start_period)
    return agency_rollup(weekly_agency_totals(ledger.where(F.col("period") >= start_period), flow))
