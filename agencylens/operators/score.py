"""Weighted, ranked scorecard."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import score_band_label
from .ranking import with_ranks


@dataclass(frozen=True)
class Metric:
    """Weight, direction (+1 or -1) and switch of one scored measure."""

    weight: float
    direction: int
    active: bool = True


# Default weights and directions. A metric the input lacks is
# left out and the weights of the others are scaled up.
DEFAULT_METRICS = {
    "tax_info_complete": Metric(5, 1),
    "efficiency": Metric(5, 1),
    "pct_clients_paid": Metric(4, 1),
    "pct_clients_managed": Metric(3, 1),
    "avg_arrears": Metric(3, -1),
    "pct_roll_forward": Metric(2, -1),
    "pct_clients_lost_track": Metric(2, -1),
    "pct_clients_settled": Metric(2, 1),
    "actions_per_client": Metric(1, 1),
    "pct_effective_actions": Metric(1, 1, active=False),
}


def agency_score(
    df: DataFrame,
    metrics: Mapping[str, Metric] | None = None,
    orientation: str = "reference",
    method: str = "window",
    store: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Add a percentile score per metric, ``score_final``, ``rank`` and ``band``.

    ``reference`` orientation gives the best value the percentile 0 (direction
    +1 ranks descending); ``higher_is_better`` gives it 100. A NULL metric has a
    NULL percentile and adds 0. Ranks and percentiles are within the segment;
    ``method`` is one of those of ``ranking``; ``split`` reads its input six times,
    so the final rank holds the plan of the percentiles six times over and that of
    ``df`` 36 times, unless ``store`` writes the percentiles and reads them back.
    """
    flip = {"reference": 1, "higher_is_better": -1}[orientation]
    used = {c: m for c, m in (metrics or DEFAULT_METRICS).items() if m.active and c in df.columns}
    if not used:
        raise ValueError("none of the active metrics is a column of the input")
    total = sum(m.weight for m in used.values())

    ranked = with_ranks(df, "segment", {c: m.direction * flip for c, m in used.items()}, True, "_percent_rank", method)
    percentiles = {f"score_{c}_pct": F.col(f"{c}_percent_rank") * 100 for c in used}
    scored = ranked.withColumns(percentiles).drop(*[f"{c}_percent_rank" for c in used])
    score = F.lit(0.0)
    for c, m in used.items():
        score = score + F.coalesce(F.col(f"score_{c}_pct") * F.lit(m.weight / total), F.lit(0.0))
    scored = scored.withColumn("score_final", score)
    if store is not None:
        scored = store(scored, "percentiles")
    placed = with_ranks(scored, "segment", {"score_final": 1}, False, "_rank", method)
    return placed.withColumnRenamed("score_final_rank", "rank").withColumn("band", score_band_label(F.col("score_final")))
