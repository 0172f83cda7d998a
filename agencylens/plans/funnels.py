"""Visit, contact and payment funnels per period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.amounts import clamp_at_zero, ratio_or_zero
from ..operators.latest import ranked_record
from ..operators.population import entry_population, restrict_to
from ..operators.transitions import with_arrears_roll, with_required_payment
from ..operators.visits import typed_contacts

# Shortest valid visit in minutes, and the segment of current clients.
PERIOD_FUNNEL_MINUTES = 1
CONTACT_FUNNEL_MINUTES = 0.5
CURRENT_SEGMENT = 3

_RECORD = ("arrears", "last_payment", "last_arrears_payment")


def _records_with_activity(
    snapshot: DataFrame, visits: DataFrame, payments: DataFrame, code_map: DataFrame, clients: DataFrame, order, min_minutes: float, clamp: bool
) -> DataFrame:
    """Last snapshot record per entity and period with that period's visits and payments.

    One aggregation over the union of the three sources instead of three
    aggregations and two joins: a single shuffle, cut map-side to one row per
    entity and period. Every source is restricted to ``clients`` first. Activity
    without a snapshot record is dropped.
    """
    contacts = typed_contacts(restrict_to(visits, clients), code_map, min_minutes, clamp)
    payments = restrict_to(payments, clients)
    sides = (
        restrict_to(snapshot, clients).select("entity_id", "period", ranked_record(*order, _RECORD).alias("_record"))
        .unionByName(
            contacts.select("entity_id", "period", "direct_contact", "effective_contact", F.lit(1).alias("visit")),
            allowMissingColumns=True,
        )
        .unionByName(
            payments.select("entity_id", "period", (clamp_at_zero("capital") + clamp_at_zero("interest")).alias("collected")),
            allowMissingColumns=True,
        )
    )
    by_period = sides.groupBy("entity_id", "period").agg(
        F.max("_record").alias("_record"),
        F.count("visit").alias("n_visits"),
        F.coalesce(F.sum("direct_contact"), F.lit(0)).alias("n_direct_contacts"),
        F.coalesce(F.sum("effective_contact"), F.lit(0)).alias("n_effective_contacts"),
        F.coalesce(F.sum("collected"), F.lit(0)).alias("collected"),
    )
    fields = [F.col("_record").getField(c).alias(c) for c in _RECORD]
    return by_period.where(F.col("_record").isNotNull()).select("*", *fields).drop("_record")


def _money_totals() -> list[Column]:
    # wide decimals: no overflow over any number of rows; required payment in whole units
    return [
        F.sum(F.col("collected").cast("decimal(38,2)")).alias("collected_total"),
        F.sum(F.col("required_payment").cast("decimal(38,0)")).alias("required_payment_total"),
    ]


def period_funnel(
    snapshot: DataFrame,
    visits: DataFrame,
    payments: DataFrame,
    code_map: DataFrame,
    phase: str,
    period: int,
    departments: Sequence[int],
    last_period: int,
    first_period: int | None = None,
    order_by: Sequence[str] = ("opened_at", "updated_at"),
    tie_break: Sequence[str] = ("record_id",),
    clamp: bool = True,
) -> DataFrame:
    """Funnel of the entities that entered at ``period``, per period.

    ``first_period`` defaults to ``period - 70`` (look-back on the period number,
    as given); it and the following one only feed look-back and are not reported.
    The entering population is one period's entry records; all sources are
    restricted to it before they are typed, measured or aggregated.
    """
    first = period - 70 if first_period is None else first_period
    chosen = F.col("department").isin(list(departments))
    recent = F.col("period") >= first
    entering = entry_population(snapshot.where(recent), period, departments)
    records = _records_with_activity(
        snapshot.where(recent & chosen),
        visits.where(recent),
        payments.where(recent & chosen),
        code_map,
        entering.select("entity_id"),
        (order_by, tie_break),
        PERIOD_FUNNEL_MINUTES,
        clamp,
    )
    moved = with_required_payment(records.join(entering, on="entity_id", how="inner"), clamped=True)
    entered = with_arrears_roll(moved)

    totals = (
        entered
        .where((F.col("period") > first + 1) & (F.col("period") <= last_period))
        .groupBy("period")
        .agg(
            # one row per entity and period, so rows count distinct entities
            F.count("entity_id").alias("n_clients"),
            F.countDistinct("department").alias("n_departments"),
            F.sum("n_visits").alias("n_visits"),
            F.sum("n_direct_contacts").alias("n_direct_contacts"),
            *_money_totals(),
            F.avg("arrears").alias("avg_arrears"),
            F.sum("roll_forward").alias("n_roll_forward"),
            F.sum("with_prev_arrears").alias("n_with_prev"),
            F.count(F.when(F.col("n_visits") > 0, 1)).alias("n_clients_visited"),
        )
    )
    return totals.select(
        F.when(F.col("period") == period, phase + "_i").otherwise(phase).alias("phase"),
        "period",
        "n_departments",
        "n_clients",
        "n_visits",
        ratio_or_zero("n_visits", "n_clients").alias("avg_visits_per_client"),
        ratio_or_zero("n_visits", "n_clients_visited").alias("avg_visits_per_visited_client"),
        "n_direct_contacts",
        ratio_or_zero("n_direct_contacts", "n_visits").alias("pct_direct_contact"),
        ratio_or_zero("n_direct_contacts", "n_clients").alias("avg_direct_contacts_per_client"),
        "collected_total",
        "required_payment_total",
        ratio_or_zero("collected_total", "required_payment_total").alias("efficiency"),
        "n_roll_forward",
        "n_with_prev",
        ratio_or_zero("n_roll_forward", "n_with_prev").alias("pct_roll_forward"),
        "avg_arrears",
    ).orderBy("period")


def contact_funnel(
    snapshot: DataFrame,
    visits: DataFrame,
    payments: DataFrame,
    code_map: DataFrame,
    clients: DataFrame,
    first_period: int,
    last_period: int,
    only_current: bool = False,
    only_non_current: bool = False,
    look_back: int | None = None,
    order_by: Sequence[str] = ("opened_at", "updated_at"),
    tie_break: Sequence[str] = ("record_id",),
    clamp: bool = True,
) -> DataFrame:
    """Contact funnel of the listed clients, per period.

    ``look_back`` is the period before ``first_period``, which its required
    payment asks for; it defaults to ``first_period - 1``, which reaches no
    earlier year. Give the calendar's period one back
    (``calendar.find_period_around``) where that matters.
    """
    in_range = F.col("period").between(first_period - 1 if look_back is None else look_back, last_period)
    base = snapshot.where(in_range)
    if only_current:
        base = base.where(F.col("segment") == CURRENT_SEGMENT)
    if only_non_current:
        base = base.where(F.col("segment") != CURRENT_SEGMENT)
    records = _records_with_activity(
        base,
        visits.where(in_range),
        payments.where(in_range),
        code_map,
        clients,
        (order_by, tie_break),
        CONTACT_FUNNEL_MINUTES,
        clamp,
    )
    listed = with_required_payment(records, clamped=True)

    totals = (
        listed
        .where(F.col("period").between(first_period, last_period))
        .groupBy("period")
        .agg(
            F.count("entity_id").alias("n_clients"),
            F.sum("n_visits").alias("n_visits"),
            F.sum("n_direct_contacts").alias("n_direct_contacts"),
            F.sum("n_effective_contacts").alias("n_effective_contacts"),
            *_money_totals(),
        )
    )
    return totals.select(
        "period",
        "n_clients",
        "n_visits",
        ratio_or_zero("n_visits", "n_clients").alias("avg_visits_per_client"),
        "n_direct_contacts",
        ratio_or_zero("n_direct_contacts", "n_visits").alias("pct_direct_contact"),
        ratio_or_zero("n_direct_contacts", "n_clients").alias("avg_direct_contacts_per_client"),
        "n_effective_contacts",
        ratio_or_zero("n_effective_contacts", "n_visits").alias("pct_effective_contact"),
        ratio_or_zero("n_effective_contacts", "n_clients").alias("avg_effective_contacts_per_client"),
        ratio_or_zero("collected_total", "required_payment_total").alias("efficiency"),
        "collected_total",
        "required_payment_total",
    ).orderBy("period")
