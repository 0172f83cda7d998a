"""The batch run: history table and agency data set, optionally scored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators.calendar import find_period_around
from ..operators.score import Metric, agency_score
from ..sources.sinks import drop_table, publish_tables, stage_table
from .dataset import Store, agency_base, agency_dataset, agency_features, agency_profile
from .history import history_base
from .incremental import update_history


@dataclass(frozen=True)
class Inputs:
    """Source frames in canonical columns (see ``sources``)."""

    calendar: DataFrame
    snapshot: DataFrame
    ledger: DataFrame
    agency_segments: DataFrame
    agency_master: DataFrame
    snapshot_order: tuple[Sequence[str], Sequence[str]]
    ledger_order: tuple[Sequence[str], Sequence[str]]


def period_bounds(calendar: DataFrame, pivot: int, n_periods: int) -> tuple[int, int]:
    """First reported period and the look-back period before it."""
    start = find_period_around(calendar, pivot, n_periods - 1)
    look_back = None if start is None else find_period_around(calendar, start, 1)
    if look_back is None:
        raise ValueError(f"the calendar has no {n_periods} periods and a look-back before {pivot}")
    return start, look_back


def reported_history(
    inputs: Inputs, pivot: int, start: int, look_back: int, segments: Sequence[int], as_of_period: int | None = None
) -> DataFrame:
    """History of the reported periods."""
    history = history_base(
        inputs.snapshot, inputs.ledger, look_back, segments, inputs.snapshot_order, inputs.ledger_order, as_of_period
    )
    return history.where(F.col("period").between(start, pivot))


def get_dataset(
    inputs: Inputs,
    pivot: int,
    start: int,
    look_back: int,
    segments: Sequence[int],
    as_of_ms: int,
    n_periods: int = 12,
    store: Store | None = None,
    history: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(history, agency data set).

    Without ``store`` nothing runs. With it, what is read more than once is written
    and read back: the history, an output and the input of the features, and the
    small tables that cut points and medians need as a whole. ``history`` is one that
    is stored already.
    """
    if history is None:
        history = reported_history(inputs, pivot, start, look_back, segments)
        if store is not None:
            history = store(history, "history")
    base = agency_base(inputs.agency_segments, inputs.agency_master, segments)
    features = agency_features(history, segments, n_periods, store=store)
    return history, agency_dataset(agency_profile(base, as_of_ms, store), features)


def run_batch(
    inputs: Inputs,
    pivot: int,
    segments: Sequence[int],
    as_of_ms: int,
    table_out: str,
    n_periods: int = 12,
    scored_table: str | None = None,
    metrics: Mapping[str, Metric] | None = None,
    orientation: str = "reference",
    method: str = "window",
    changed_from: int | None = None,
) -> None:
    """Build and save ``<table_out>_history`` and ``<table_out>``, and the scores if ``scored_table`` is named.

    History is written once, by period, and the features read that table: later
    runs prune to the periods they need. All tables are written beside the former
    ones and take their names together at the end. An error propagates and leaves
    the former tables; tables in between are dropped either way. ``metrics``,
    ``orientation`` and ``method`` are those of ``agency_score``.

    With ``changed_from``, the stored history is kept and brought up to date (see
    ``update_history``) for sources that changed from that period on. Its first
    period must still be that of this run: one more period, one more in ``n_periods``.
    """
    spark = inputs.calendar.sparkSession
    start, look_back = period_bounds(inputs.calendar, pivot, n_periods)
    staged: dict[str, str] = {}
    passing: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        table = f"{table_out}_{name}"
        if name == "history":
            staged[table] = stage_table(df, table, partition_by=("period",))
            return spark.table(staged[table])
        passing.append(stage_table(df, table))
        return spark.table(passing[-1])

    try:
        stored = None
        if changed_from is not None:
            table = f"{table_out}_history"
            first = spark.table(table).agg(F.min("period")).first()[0]
            if first is not None and first < start:
                raise ValueError(f"{table} begins at {first}, this run at {start}")
            update_history(
                table, inputs.snapshot, inputs.ledger, start, pivot, look_back, segments,
                inputs.snapshot_order, inputs.ledger_order, changed_from,
            )
            stored = spark.table(table).where(F.col("period").between(start, pivot))
        _, dataset = get_dataset(inputs, pivot, start, look_back, segments, as_of_ms, n_periods, keep, stored)
        staged[table_out] = stage_table(dataset, table_out)
        if scored_table is not None:
            scored = agency_score(spark.table(staged[table_out]), metrics, orientation, method, keep if method == "split" else None)
            staged[scored_table] = stage_table(scored, scored_table)
        publish_tables(spark, staged)
    finally:
        for table in (*passing, *staged.values()):
            drop_table(spark, table)
