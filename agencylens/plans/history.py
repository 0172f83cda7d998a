"""Client-period history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.amounts import flag, positive_sum
from ..operators.latest import ranked_record
from ..operators.ledger import with_plan_flag
from ..operators.population import entity_population, restrict_to
from ..operators.transitions import with_arrears_roll, with_required_payment, with_segment_transitions

SNAPSHOT_FIELDS = (
    "segment",
    "arrears",
    "balance",
    "last_payment",
    "last_arrears_payment",
    "n_actions",
    "n_actions_unpaid",
)
LEDGER_FIELDS = ("agency", "plan_active")


def _ledger_side(usable, order) -> DataFrame:
    same_manager = Window.partitionBy("entity_id", "period", "manager").orderBy("manager")
    first = (F.row_number().over(same_manager) == 1) & F.col("manager").isNotNull()
    return with_plan_flag(usable).withColumn("_first", first).select(
        "entity_id",
        "period",
        ranked_record(*order, LEDGER_FIELDS).alias("_entry"),
        positive_sum("capital", "interest").alias("collected"),
        "auto_charge",
        "captation",
        flag(F.col("_first")).alias("new_manager"),
    )


def with_outcome_flags(history: DataFrame) -> DataFrame:
    """Add ``debt_settled`` and ``lost_track``."""
    in_legal = F.col("in_legal") == 1
    settled = in_legal & (F.col("collected") >= F.col("balance"))
    nothing_follows = (F.col("with_next_arrears") == 0) & (F.col("with_next_segment") == 0)
    return history.withColumn("debt_settled", flag(settled)).withColumn(
        "lost_track", flag(in_legal & nothing_follows & (F.col("debt_settled") == 0))
    )


def history_base(
    snapshot: DataFrame,
    ledger: DataFrame,
    start_period: int,
    segments: Sequence[int],
    snapshot_order: tuple[Sequence[str], Sequence[str]],
    ledger_order: tuple[Sequence[str], Sequence[str]],
    as_of_period: int | None = None,
    prefilter_bits: int | None = None,
    members: DataFrame | None = None,
) -> DataFrame:
    """Client-period history: last snapshot records with movements and recoveries.

    The population is every entity seen in the segments after ``start_period``.
    Both sources are restricted to it before anything is aggregated or shuffled
    for more: its scan reads three columns, and whether it is broadcast or merged
    is the planner's choice by its size; ``prefilter_bits`` as in ``restrict_to``. Rows are one per entity and period before anything is shuffled by entity,
    so an entity with very many records does not burden one task, and the result
    stays laid out by entity for the aggregations that follow.

    Entity-periods without ledger rows are left out at the end, after they have
    served as neighbours. ``members`` (``entity_id``) belong to the population
    besides, whatever the given records say of them. The ``*_order`` arguments are (ordering columns,
    tie-break columns) of the last record. ``as_of_period`` hides later periods
    from the look-ahead columns.
    """
    # Both sources are cut to one row per entity and period in one aggregation
    # over their union: one shuffle for both, and no join of the two afterwards.
    # A manager counts at its first row of the entity and period, so that the
    # records meet one aggregation; a distinct count would put two more below it.
    seen = snapshot.where((F.col("period") >= start_period) & F.col("entity_id").isNotNull())
    if as_of_period is not None:
        seen = seen.where(F.col("period") <= as_of_period)
    usable = ledger.where((F.col("period") >= start_period) & F.col("entity_id").isNotNull() & F.col("agency").isNotNull())
    chosen = entity_population(seen, start_period, segments)
    if members is not None:
        chosen = chosen.union(members.select("entity_id")).distinct()
    records = restrict_to(seen, chosen, prefilter_bits=prefilter_bits).select("entity_id", "period", ranked_record(*snapshot_order, SNAPSHOT_FIELDS).alias("_record"))
    sides = records.unionByName(_ledger_side(restrict_to(usable, chosen, prefilter_bits=prefilter_bits), ledger_order), allowMissingColumns=True)
    by_period = sides.groupBy("entity_id", "period").agg(
        F.max("_record").alias("_record"),
        F.max("_entry").alias("_entry"),
        F.sum("collected").alias("collected"),
        F.sum("auto_charge").alias("auto_charge"),
        F.sum("captation").alias("captation"),
        F.coalesce(F.sum("new_manager"), F.lit(0)).alias("n_managers"),
    )
    observed = by_period.where(F.col("_record").isNotNull()).select(
        "entity_id",
        "period",
        *[F.col("_record").getField(c).alias(c) for c in SNAPSHOT_FIELDS],
        *[F.col("_entry").getField(c).alias(c) for c in LEDGER_FIELDS],
        "collected",
        "auto_charge",
        "captation",
        "n_managers",
    )
    moved = with_segment_transitions(with_arrears_roll(with_required_payment(observed)), segments)
    recovered = moved.where(F.col("agency").isNotNull())
    return with_outcome_flags(
        recovered.withColumn("paid", flag(F.col("collected") > 0)).drop("last_payment", "last_arrears_payment")
    )
