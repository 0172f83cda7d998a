"""Trends of the weekly ratios per agency and segment.

A series is one agency-segment's observed periods, so its window and its
regression are bounded by the calendar. Cut points are exact quantiles over all
series, computed in the plan as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import stability_label, tercile_label, trend_profile_label, with_enough_periods
from ..functions.amounts import flag
from ..functions.stats import ols_slope
from .quantile import bracketed_quantiles
from .ratios import AGENCY_SEGMENT

# Weekly measure -> name of its trend, in the order of the established layout.
TRENDS = {
    "efficiency": "efficiency",
    "avg_arrears": "arrears",
    "actions_per_client": "actions",
    "pct_effective_actions": "effective_actions",
    "pct_clients_paid": "paid",
    "pct_clients_settled": "settled",
    "pct_clients_managed": "managed",
    "pct_clients_lost_track": "lost_track",
    "pct_clients_left": "left",
    "pct_clients_entered": "entered",
    "pct_clients_plan_active": "plan_active",
    "balance_per_client": "balance_per_client",
    "pct_roll_forward": "roll_forward",
    "pct_roll_backward": "roll_backward",
}

# Quantiles that cut the slopes into three classes.
TERCILES = (0.33, 0.66)


def with_time_index(weekly: DataFrame, keys: Sequence[str] = AGENCY_SEGMENT) -> DataFrame:
    """Add ``t`` = 1, 2, ... over the series' observed periods."""
    return weekly.withColumn("t", F.row_number().over(Window.partitionBy(*keys).orderBy("period")))


def trend_aggregates(null_handling: str = "reference", prefix: str = "") -> list[Column]:
    """Observed periods, the 14 slopes and the deviation of the efficiency.

    ``prefix`` is that of the weekly measure columns.
    """
    slopes = [ols_slope(prefix + m, "t", null_handling).alias(f"slope_{name}") for m, name in TRENDS.items()]
    deviation = F.stddev(f"{prefix}efficiency").alias("std_efficiency")
    return [F.count("period").alias("n_periods_observed"), *slopes, deviation]


def trend_slopes(weekly: DataFrame, null_handling: str = "reference") -> DataFrame:
    """Slope of every weekly measure per (agency, segment)."""
    return with_time_index(weekly).groupBy(*AGENCY_SEGMENT).agg(*trend_aggregates(null_handling))


def cut_points(slopes: DataFrame) -> DataFrame:
    """One row with struct ``_cuts``: terciles of every slope, median deviation, by rank over all series."""
    low, high = TERCILES
    wanted = {"median_std_efficiency": ("std_efficiency", 0.5)}
    for name in TRENDS.values():
        wanted |= {f"low_{name}": (f"slope_{name}", low), f"high_{name}": (f"slope_{name}", high)}
    # of all columns, so that this reads the very shuffle that the labels read, not a narrower one
    whole = F.xxhash64(*[F.col(c) for c in slopes.columns])
    found = bracketed_quantiles(slopes, wanted, whole=whole)
    return found.select(F.struct(*wanted, F.col("_read").alias("read")).alias("_cuts"))


def with_trend_labels(slopes: DataFrame) -> DataFrame:
    """Add the 14 trend labels, the stability label, the trend score and profile.

    The score counts efficiency rising, arrears falling and roll-forward falling
    (cut points included, short series too); a NULL slope scores 0.

    Series are laid out once, and that shuffle feeds cut points and labels: what
    lies behind the slopes is evaluated once.
    """
    # by a hash of the keys, as the planner would drop a shuffle by the keys themselves and evaluate the slopes twice
    laid = slopes.repartition(F.xxhash64(*AGENCY_SEGMENT))
    # one row; it is missing only if there are no series
    with_cuts = laid.join(F.broadcast(cut_points(laid)), F.col("_cuts.read").isNotNull())

    def cut(name: str) -> Column:
        return F.col("_cuts").getField(name)

    labels = {
        f"trend_{name}": with_enough_periods(
            F.col("n_periods_observed"), tercile_label(F.col(f"slope_{name}"), cut(f"low_{name}"), cut(f"high_{name}"))
        )
        for name in TRENDS.values()
    }
    score = (
        flag(F.col("slope_efficiency") >= cut("high_efficiency"))
        + flag(F.col("slope_arrears") <= cut("low_arrears"))
        + flag(F.col("slope_roll_forward") <= cut("low_roll_forward"))
    )
    labels["stability_efficiency"] = stability_label(F.col("std_efficiency"), cut("median_std_efficiency"))
    labels["trend_score"] = score
    labels["trend_profile"] = trend_profile_label(score)
    return with_cuts.withColumns(labels).drop("_cuts")


TREND_OUTPUT = (*[f"trend_{n}" for n in TRENDS.values()], "stability_efficiency", "trend_score", "trend_profile")


def trend_labels(slopes: DataFrame) -> DataFrame:
    """Keys and trend labels only."""
    return with_trend_labels(slopes).select(*AGENCY_SEGMENT, *TREND_OUTPUT)
