"""Performance ratios per agency and segment, optionally per period.

Everything starts from one additive cube, ``period_totals``: sums per (agency,
segment, period). Distinct clients are made additive by flagging, inside each
entity's timeline, its first appearance per agency and segment. Global and
weekly ratios are then roll-ups of the same small cube, history is read once,
and no count-distinct expands the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.amounts import flag, ratio_or_null
from ..functions.labels import efficiency_label, share_label

AGENCY_SEGMENT = ("agency", "segment")

# cube column -> what it sums over history rows
_SUMMED = {
    "n_paid": "paid",
    "n_settled": "debt_settled",
    "n_lost_track": "lost_track",
    "n_left": "out_legal",
    "n_entered": "enter_legal",
    "n_plan_active": "plan_active",
    "collected": "collected",
    "required_payment": "required_payment",
    "balance": "balance",
    "n_actions": "n_actions",
    "n_actions_unpaid": "n_actions_unpaid",
    "n_with_prev": "with_prev_arrears",
    "n_with_next": "with_next_arrears",
    "sum_arrears": "arrears",
}

# The measures in the order of the established layout.
MEASURES = (
    "n_clients",
    "collected",
    "required_payment",
    "efficiency",
    "n_actions",
    "pct_clients_managed",
    "pct_clients_paid",
    "pct_clients_settled",
    "pct_clients_lost_track",
    "pct_clients_left",
    "pct_clients_entered",
    "pct_clients_plan_active",
    "balance_per_client",
    "actions_per_client",
    "pct_effective_actions",
    "pct_roll_forward",
    "pct_roll_backward",
    "avg_arrears",
)


def period_totals(history: DataFrame) -> DataFrame:
    """Additive totals per (agency, segment, period).

    ``n_clients``/``n_managed`` count distinct entities within the period,
    ``new_clients``/``new_managed`` only at their first period with the agency
    and segment, so summing the latter over periods counts each entity once.
    """
    timeline = Window.partitionBy("entity_id", *AGENCY_SEGMENT).orderBy("period")
    managed = F.col("n_actions") > 0
    earlier = timeline.rowsBetween(Window.unboundedPreceding, -1)
    marked = history.withColumns(
        {
            "_seen": F.max("period").over(earlier),
            "_managed": F.max(F.when(managed, F.col("period"))).over(earlier),
        }
    )
    known = F.col("entity_id").isNotNull()

    def first_in_period(last: Column) -> Column:
        return last.isNull() | (last != F.col("period"))

    sums = [F.sum(source).alias(name) for name, source in _SUMMED.items()]
    return marked.groupBy(*AGENCY_SEGMENT, "period").agg(
        F.sum(flag(known & first_in_period(F.col("_seen")))).alias("n_clients"),
        F.sum(flag(known & managed & first_in_period(F.col("_managed")))).alias("n_managed"),
        F.sum(flag(known & F.col("_seen").isNull())).alias("new_clients"),
        F.sum(flag(known & managed & F.col("_managed").isNull())).alias("new_managed"),
        *sums,
        F.sum(F.when(F.col("with_prev_arrears") == 1, F.col("roll_forward"))).alias("n_roll_forward"),
        F.sum(F.when(F.col("with_next_arrears") == 1, F.col("roll_backward"))).alias("n_roll_backward"),
        F.count("arrears").alias("n_arrears"),
    )


ROLLED_UP = (*_SUMMED, "n_roll_forward", "n_roll_backward", "n_arrears")


def global_totals() -> list[Column]:
    """Aggregates that roll the period cube up to (agency, segment)."""
    return [
        F.sum("new_clients").alias("n_clients"),
        F.sum("new_managed").alias("n_managed"),
        *[F.sum(c).alias(c) for c in ROLLED_UP],
    ]


def measure_columns(prefix: str = "") -> dict[str, Column]:
    """The 18 measures as expressions over the (prefixed) total columns.

    Shares divide client-period sums by distinct clients, so over several
    periods they can exceed 1.
    """

    def total(name: str) -> Column:
        return F.col(prefix + name)

    def per_client(name: str) -> Column:
        return ratio_or_null(total(name), total("n_clients"))

    return {
        "n_clients": total("n_clients"),
        "collected": total("collected"),
        "required_payment": total("required_payment"),
        "efficiency": ratio_or_null(total("collected"), total("required_payment")),
        "n_actions": total("n_actions"),
        "pct_clients_managed": per_client("n_managed"),
        "pct_clients_paid": per_client("n_paid"),
        "pct_clients_settled": per_client("n_settled"),
        "pct_clients_lost_track": per_client("n_lost_track"),
        "pct_clients_left": per_client("n_left"),
        "pct_clients_entered": per_client("n_entered"),
        "pct_clients_plan_active": per_client("n_plan_active"),
        "balance_per_client": per_client("balance"),
        "actions_per_client": per_client("n_actions"),
        "pct_effective_actions": ratio_or_null(total("n_actions") - total("n_actions_unpaid"), total("n_actions")),
        "pct_roll_forward": ratio_or_null(total("n_roll_forward"), total("n_with_prev")),
        "pct_roll_backward": ratio_or_null(total("n_roll_backward"), total("n_with_next")),
        "avg_arrears": ratio_or_null(total("sum_arrears"), total("n_arrears")),
    }


def agency_ratios(history: DataFrame, by_period: bool = False) -> DataFrame:
    """The 18 measures per (agency, segment), or per (agency, segment, period)."""
    totals = period_totals(history)
    keys = [*AGENCY_SEGMENT]
    if by_period:
        keys.append("period")
    else:
        totals = totals.groupBy(*keys).agg(*global_totals())
    return totals.select(*keys, *[c.alias(n) for n, c in measure_columns().items()])


def with_ratio_categories(ratios: DataFrame) -> DataFrame:
    """Add the efficiency, management-intensity and paying-share classes."""
    return ratios.withColumns(
        {
            "cat_efficiency": efficiency_label(F.col("efficiency")),
            "cat_management_intensity": share_label(F.col("pct_clients_managed")),
            "cat_effective_management": share_label(F.col("pct_clients_paid")),
        }
    )
