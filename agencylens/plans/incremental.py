"""A stored history brought up to date, without writing the periods that nothing changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.population import restrict_to
from ..sources.sinks import drop_table, replace_partitions, stage_table
from .history import history_base


def _former_records(snapshot: DataFrame, changed: DataFrame, look_back: int, changed_from: int) -> DataFrame:
    return restrict_to(snapshot.where((F.col("period") >= look_back) & (F.col("period") < changed_from)), changed)


def altered_entities(
    snapshot: DataFrame, changed: DataFrame, look_back: int, segments: Sequence[int], changed_from: int
) -> DataFrame:
    """What the changed entities' new records alter, one row per changed entity.

    ``settled``: its former records alone put it in the population. Then, before
    ``changed_from``, only the row of the last period it was observed in alters (its
    look-ahead columns); otherwise all of its rows do. ``since`` is the first period
    that alters, ``needs`` the first whose snapshots that takes, ``touched`` the
    altered periods before ``changed_from``.
    """
    qualifies = (F.col("period") > look_back) & F.coalesce(F.col("segment").isin(list(segments)), F.lit(False))
    by_entity = _former_records(snapshot, changed, look_back, changed_from).groupBy("entity_id").agg(
        F.max(qualifies).alias("settled"),
        F.sort_array(F.collect_set("period"), asc=False).alias("periods"),  # bounded by the calendar
    )
    settled, last = F.col("settled"), F.get("periods", F.lit(0))
    return changed.join(by_entity, "entity_id", "left").withColumn("settled", F.coalesce("settled", F.lit(False))).select(
        "entity_id",
        "settled",
        F.when(settled, last).otherwise(look_back).alias("since"),
        F.when(settled, F.coalesce(F.get("periods", F.lit(1)), last)).otherwise(look_back).alias("needs"),
        F.when(settled, F.array(last)).otherwise(F.col("periods")).alias("touched"),
    )


def _from_period(rows: DataFrame, altered: DataFrame, first: str, how: str) -> DataFrame:
    """Semi or anti join with the entities' rows from the period in column ``first`` on."""
    bounds = altered.select(F.col("entity_id").alias("_entity"), F.col(first).alias("_first"))
    return rows.join(bounds, (F.col("entity_id") == F.col("_entity")) & (F.col("period") >= F.col("_first")), how)


def update_history(
    table: str,
    snapshot: DataFrame,
    ledger: DataFrame,
    start: int,
    pivot: int,
    look_back: int,
    segments: Sequence[int],
    snapshot_order: tuple[Sequence[str], Sequence[str]],
    ledger_order: tuple[Sequence[str], Sequence[str]],
    changed_from: int,
) -> list[int]:
    """Bring a history table, partitioned by period, up to date; returns the periods that were written.

    The table holds the periods from ``start`` of a run with the same ``look_back``
    and segments. Sources before ``changed_from`` are as they were at that run; from
    it on, rows were added or replaced, none taken away. The table is then what a
    full run would write. Computed are only the rows that alter (see
    ``altered_entities``), from the snapshots of their periods and of the one before;
    other rows of a touched period are copied, other periods are not opened.

    What is to be written is staged beside the table first, so a run that fails
    before that leaves the table as it was, and one that fails later can be repeated.
    """
    spark = snapshot.sparkSession
    if changed_from <= look_back:
        raise ValueError("a change of the look-back period needs a full run")
    helpers: list[str] = []
    try:
        # small: distinct entities, then one row for each, which several branches read
        recent = snapshot.where((F.col("period") >= changed_from) & F.col("entity_id").isNotNull())
        helpers.append(stage_table(recent.select("entity_id").distinct(), f"{table}_changed"))
        changed = spark.table(helpers[0])
        known = snapshot.where(F.col("period").between(changed_from, pivot)).select("period").distinct()
        stored = spark.table(table)
        held = stored.where(F.col("period") >= changed_from).select("period").distinct()
        helpers.append(stage_table(altered_entities(snapshot, changed, look_back, segments, changed_from), f"{table}_altered"))
        altered = spark.table(helpers[1])
        touched = altered.select(F.explode("touched").alias("period")).union(known).union(held).distinct()
        periods = sorted(r["period"] for r in touched.where(F.col("period").between(start, pivot)).collect())  # bounded by the calendar
        if not periods:
            return []

        here = F.col("period").isin(periods)
        own = _from_period(snapshot.where(F.col("period") >= look_back), altered, "needs", "left_semi")
        entries = _from_period(ledger.where(here), altered, "since", "left_semi")
        fresh = history_base(
            own, entries, look_back, segments, snapshot_order, ledger_order, members=altered.where("settled")
        ).where(here & (F.col("period") <= pivot))
        same = _from_period(stored.where(here & (F.col("period") < changed_from)), altered, "since", "left_anti")
        helpers.append(stage_table(same.unionByName(fresh.select(*stored.columns)), f"{table}_update", ("period",)))
        replace_partitions(spark.table(helpers[2]), table, {"period": periods})
        return periods
    finally:
        for helper in helpers:
            drop_table(spark, helper)
