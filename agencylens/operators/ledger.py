"""Recoveries and payments per entity and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.amounts import flag, positive_sum
from .latest import latest_with_aggregates

# Fixed value: plan text that marks an active payment plan.
ACTIVE_PLAN = "PLAN ACTIVO"

ENTITY_PERIOD = ("entity_id", "period")


def with_plan_flag(ledger: DataFrame) -> DataFrame:
    """Add ``plan_active``, 1 for the active-plan text."""
    return ledger.withColumn("plan_active", flag(F.col("plan") == ACTIVE_PLAN))


def ledger_by_entity_period(ledger: DataFrame, order_by: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """One row per entity and period: amounts collected and the last record's agency.

    The whole period's amount is credited to the agency of the last record,
    whoever collected it. The last record and the totals come from one
    aggregation instead of two branches and a join.
    """
    usable = ledger.where("entity_id IS NOT NULL AND agency IS NOT NULL AND period IS NOT NULL")
    return latest_with_aggregates(
        with_plan_flag(usable),
        keys=ENTITY_PERIOD,
        order_by=order_by,
        tie_break=tie_break,
        take=("agency", "plan_active"),
        aggregates=(
            F.sum(positive_sum("capital", "interest")).alias("collected"),
            F.sum("auto_charge").alias("auto_charge"),
            F.sum("captation").alias("captation"),
            F.countDistinct("manager").alias("n_managers"),
        ),
    ).withColumn("paid", flag(F.col("collected") > 0))


def multi_channel_flag(payments: DataFrame) -> DataFrame:
    """1 where an entity paid through more than one collection type in a period."""
    # min <> max says "more than one distinct value" without a distinct count
    mixed = F.min("collection_type") != F.max("collection_type")
    return payments.groupBy(*ENTITY_PERIOD).agg(flag(mixed).alias("multi_channel"))


def actions_by_entity_period(actions: DataFrame, lowest_code: int = 800) -> DataFrame:
    """Number of actions and distinct managers, action codes from ``lowest_code`` up."""
    return (
        actions.where(F.col("action_code") >= lowest_code)
        .groupBy(*ENTITY_PERIOD)
        .agg(F.count(F.lit(1)).alias("n_actions"), F.countDistinct("manager").alias("n_managers"))
    )


def payments_by_period(payments: DataFrame, start_period: int, end_period: int, keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """Positive payments and a paid indicator per entity and period."""
    amount = positive_sum("capital", "interest")
    return (
        payments.where(F.col("period").between(start_period, end_period))
        .groupBy(*keys, "period")
        .agg(F.sum(amount).alias("payment"), F.max(flag(amount > 0)).alias("payment_indicator"))
    )


def with_cumulative_payment(payments: DataFrame, keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """Running total of ``payment`` over the entity's periods."""
    so_far = Window.partitionBy(*keys).orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return payments.withColumn("payment_cumulative", F.sum("payment").over(so_far))


# Columns summed and columns taken at closing, in the order of the established layout.
FLOW_AMOUNTS = ("payment", "auto_charge_due", "auto_charge", "captation")
CLOSING_STATE = (
    "arrears",
    "days_late",
    "account_class",
    "days_late_at_payment",
    "portfolio_type",
    "judicial_flag",
    "portfolio_origin",
    "balance",
    "balance_late",
    "interest_due",
    "telephony_flag",
)


def payment_flow_and_close(
    cash: DataFrame,
    order_by: Sequence[str],
    tie_break: Sequence[str] = (),
    start_period: int | None = None,
    amounts: Sequence[str] = FLOW_AMOUNTS,
    state: Sequence[str] = CLOSING_STATE,
) -> DataFrame:
    """Flow and closing state per (entity, agency, segment, period), suffix ``_paid``.

    Flow is the sum of the amounts and the number of payments; the closing state
    comes from the last payment. A column that the input lacks is an error; name
    a shorter list for a source that has fewer.
    """
    if missing := [c for c in (*amounts, *state) if c not in cash.columns]:
        raise ValueError(f"the payments have no {', '.join(missing)}")
    keys = ("entity_id", "agency", "segment", "period")
    rows = cash if start_period is None else cash.where(F.col("period") >= start_period)
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    flow = [F.sum(c).alias(f"{c}_paid") for c in amounts]
    closing = list(state)
    summed = latest_with_aggregates(
        rows, keys, order_by, closing, [*flow, F.count(F.lit(1)).alias("n_payments_paid")], tie_break
    )
    return summed.withColumnsRenamed({c: f"{c}_at_close" for c in closing})
