"""Agency profile, agency features and the joined agency data set."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators import quality
from ..operators.ratios import AGENCY_SEGMENT, MEASURES, global_totals, measure_columns, period_totals, with_ratio_categories
from ..operators.trend import TREND_OUTPUT, trend_aggregates, with_time_index, with_trend_labels

# Fixed value: periods the client total is averaged over unless told otherwise.
PERIODS_PER_HISTORY = 12

Store = Callable[[DataFrame, str], DataFrame]


def agency_base(agency_segments: DataFrame, agency_master: DataFrame, segments: Sequence[int]) -> DataFrame:
    """Agency-segments of the given segments with their master data (left join)."""
    chosen = agency_segments.where(F.col("segment").isin(list(segments)))
    return chosen.join(agency_master, on="agency", how="left")


def agency_profile(base: DataFrame, as_of_ms: int, store: Store | None = None) -> DataFrame:
    """Clean, impute, bound and validate the agency base.

    Outlier cuts and medians each need the whole base before any row is done;
    ``store`` keeps the joined base, so that the join is not repeated for them.
    """
    dense = quality.drop_sparse_rows(base)
    if store is not None:
        dense = store(dense, "agency_base")
    cleaned = quality.fill_missing(dense, {"external_company": ""})
    cleaned = quality.null_outliers(quality.repair_status_dates(cleaned, as_of_ms))
    complete = quality.enforce_capacity_bounds(quality.impute_group_medians(cleaned))
    return quality.with_capacity_ratios(quality.with_tenure(quality.with_field_validity(complete)))


def agency_features(
    history: DataFrame,
    segments: Sequence[int],
    n_periods: int = PERIODS_PER_HISTORY,
    null_handling: str = "reference",
    store: Store | None = None,
) -> DataFrame:
    """Ratios, classes and trend labels per (agency, segment).

    One pass over history: the period cube carries both the weekly measures of
    the trend and the totals of the global measures. ``store`` keeps the result
    of that pass (one row per agency and segment), so that the cut points, which
    need all of it before any label, do not evaluate history a second time.
    """
    cube = period_totals(history.where(F.col("segment").isin(list(segments))))
    weekly = {f"week_{name}": measure for name, measure in measure_columns().items()}
    summed = (
        with_time_index(cube.withColumns(weekly))
        .groupBy(*AGENCY_SEGMENT)
        .agg(*global_totals(), *trend_aggregates(null_handling, prefix="week_"))
    )
    for_trends = [c for c in summed.columns if c.startswith(("slope_", "std_", "n_periods_"))]
    measured = summed.select(*AGENCY_SEGMENT, *[c.alias(n) for n, c in measure_columns().items()], *for_trends)
    if store is not None:
        measured = store(measured, "agency_measures")
    return with_trend_labels(with_ratio_categories(measured)).select(
        *AGENCY_SEGMENT,
        *MEASURES,
        "cat_efficiency",
        "cat_management_intensity",
        "cat_effective_management",
        (F.col("n_clients") / n_periods).alias("avg_clients"),
        *TREND_OUTPUT,
    )


def agency_dataset(profile: DataFrame, features: DataFrame) -> DataFrame:
    """Agency-segments that have both a profile and history."""
    return profile.join(features, on=list(AGENCY_SEGMENT), how="inner")
