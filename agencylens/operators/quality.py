"""Cleaning, imputation and validity of agency master data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from ..functions.amounts import flag, ratio_or_zero
from ..functions.periods import tenure_days
from ..functions import validity
from .quantile import SKETCH_ACCURACY, bracketed_quantiles

CAPACITIES = ("ideal_capacity", "min_capacity", "max_capacity")

# Fixed value: quantile above which a capacity counts as an outlier.
OUTLIER_QUANTILE = 0.95


def drop_sparse_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which more than half the fields and one are empty: NULL or, in numeric columns, 0."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    filled = [F.nullif(F.col(c), F.lit(0)) if c in numeric else F.col(c) for c in df.columns]
    n_filled = F.size(F.filter(F.array(*[c.isNotNull() for c in filled]), lambda known: known))
    return df.where(len(df.columns) - n_filled <= len(df.columns) / 2 + 1)


def fill_missing(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace NULL by a constant per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def repair_status_dates(df: DataFrame, as_of_ms: int) -> DataFrame:
    """Active agencies lose their end date; inactive ones without one end at ``as_of_ms``."""
    status, end = F.col("status"), F.col("end_ms")
    repaired = F.when(status == 1, None).when((status == 0) & end.isNull(), F.lit(as_of_ms)).otherwise(end)
    return df.withColumn("end_ms", repaired.cast("long"))


def _quantiles(df: DataFrame, columns: Sequence[str], quantile: float, group: str | None, method: str) -> DataFrame:
    """One struct column ``_quantiles`` per ``_group``, or one row for all.

    ``exact`` selects by rank, for groups of any size; ``sketch`` is one
    aggregation, exact up to about ``SKETCH_ACCURACY`` rows a group.
    """
    if method == "exact":
        found = bracketed_quantiles(df, {c: (c, quantile) for c in columns}, group)
        return found.select(*([] if group is None else ["_group"]), F.struct(*columns).alias("_quantiles"))
    if method != "sketch":
        raise ValueError(f"unknown method {method!r}")
    rows = df if group is None else df.groupBy(F.col(group).alias("_group"))
    return rows.agg(F.struct(*[F.percentile_approx(c, F.lit(quantile), F.lit(SKETCH_ACCURACY)).alias(c) for c in columns]).alias("_quantiles"))


def null_outliers(df: DataFrame, columns: Sequence[str] = CAPACITIES, quantile: float = OUTLIER_QUANTILE, method: str = "exact") -> DataFrame:
    """Set 0 and values above the column's quantile to NULL.

    The quantiles are one row computed inside the plan (scalar subquery), not a
    separate job that blocks the driver. No quantile (all NULL) means no cut.
    """
    with_cuts = df.withColumn("_cuts", _quantiles(df, columns, quantile, None, method).scalar())
    cleaned = {c: F.when((F.col(c) == 0) | (F.col(c) > F.col("_cuts").getField(c)), None).otherwise(F.col(c)) for c in columns}
    return with_cuts.withColumns(cleaned).drop("_cuts")


def impute_group_medians(df: DataFrame, columns: Sequence[str] = CAPACITIES, group: str = "segment", method: str = "exact") -> DataFrame:
    """Every NULL of ``columns`` becomes the median of its group; a group without any value keeps NULL.

    All groups count. How the few medians meet the rows is the planner's choice.
    """
    medians = _quantiles(df, columns, 0.5, group, method)
    matched = df.join(medians, F.col(group).eqNullSafe(F.col("_group")), "left")
    return matched.withColumns({c: F.coalesce(c, F.col("_quantiles").getField(c)) for c in columns}).drop("_group", "_quantiles")


def enforce_capacity_bounds(df: DataFrame) -> DataFrame:
    """The minimum never exceeds, the maximum never undercuts the ideal capacity."""
    ideal = F.col("ideal_capacity")
    return df.withColumns(
        {
            "min_capacity": F.least(F.col("min_capacity"), ideal),
            "max_capacity": F.greatest(F.col("max_capacity"), ideal),
        }
    )


def with_field_validity(df: DataFrame) -> DataFrame:
    """Replace the raw contact and tax fields by 0/1 validity columns."""
    checks = {
        "valid_phone": ("phone", validity.digits_valid("phone", *validity.PHONE_DIGITS)),
        "valid_postcode": ("postcode", validity.digits_valid("postcode", *validity.POSTCODE_DIGITS)),
        "has_external_collection": ("external_company", validity.text_present("external_company")),
        "has_legal_name": ("legal_name", validity.text_present("legal_name")),
        "valid_email": ("email", validity.pattern_valid("email", validity.EMAIL_PATTERN)),
        "valid_tax_id": ("tax_id", validity.pattern_valid("tax_id", validity.TAX_ID_PATTERN)),
        "valid_tax_suffix": ("tax_suffix", validity.pattern_valid("tax_suffix", validity.SUFFIX_PATTERN)),
    }
    return df.withColumns({name: check for name, (_, check) in checks.items()}).drop(*[raw for raw, _ in checks.values()])


def with_tenure(df: DataFrame) -> DataFrame:
    """Replace start and end by the tenure in days."""
    return df.withColumn("seniority_days", tenure_days("start_ms", "end_ms")).drop("start_ms", "end_ms")


def with_capacity_ratios(df: DataFrame) -> DataFrame:
    """Add the capacity ratios and range; range ratios are NULL without a positive base."""
    ideal, low, high = (F.col(c) for c in CAPACITIES)
    spread = high - low

    def per(base):
        return F.when(base > 0, spread.cast("double") / base.cast("double"))

    return df.withColumns(
        {
            "min_over_ideal_capacity": ratio_or_zero("min_capacity", "ideal_capacity"),
            "min_over_max_capacity": ratio_or_zero("min_capacity", "max_capacity"),
            "capacity_range": spread,
            "range_over_ideal_capacity": per(ideal),
            "range_over_max_capacity": per(high),
        }
    )
