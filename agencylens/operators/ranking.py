"""Rank and percent rank of several columns within a group.

Two ways to the same ranks; the caller chooses, no count does:

``window``  one window per column, all on one shuffle by group. A whole group
            passes through one task, sorted with spill.
``split``   each value's rank is (rows in better buckets) + (rows with a better
            value in its own bucket). Equal rows and equal values are counted
            map-side before they are shuffled, and buckets are cut at the
            distinct values with the smallest hashes, the same ones however often
            they are evaluated, so neither a large group nor a value shared by
            many rows is ordered by one task. What grows with the rows is merged,
            never broadcast. What is left to AQE's skew join is the last join,
            which puts the ranks back on rows.

Values are compared in their own type: NaN is larger than any number, NULL comes
last, and a NULL group is a group.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegralType

from .quantile import bucket_of, cuts_by_hash

BUCKETS = 256


def with_ranks(
    df: DataFrame,
    group: str,
    directions: Mapping[str, int],
    percent: bool,
    suffix: str,
    method: str = "window",
) -> DataFrame:
    """Add ``<column><suffix>`` for every column of ``directions``.

    Direction +1 ranks the largest value first, -1 the smallest; NULL ranks
    last. ``percent`` gives ``(rank - 1) / (rows - 1)``, NULL for a NULL value,
    0 in a one-row group; otherwise the plain rank with ties sharing one rank.
    """
    if method == "window":
        return _by_window(df, group, directions, percent, suffix)
    if method == "split":
        return _by_split(df, group, directions, percent, suffix)
    raise ValueError(f"unknown method {method!r}")


def _ordered(column: str | Column, direction: int) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.desc_nulls_last() if direction == 1 else value.asc_nulls_last()


def _by_window(df, group, directions, percent, suffix):
    ranks = {}
    for column, direction in directions.items():
        window = Window.partitionBy(group).orderBy(_ordered(column, direction))
        if percent:
            rank = F.when(F.col(column).isNotNull(), F.percent_rank().over(window))
        else:
            rank = F.rank().over(window)
        ranks[f"{column}{suffix}"] = rank
    return df.withColumns(ranks)


def _comparable(df: DataFrame, directions: Mapping[str, int]) -> tuple[list[Column], list[str]]:
    """One struct per column whose fields, in order and ascending, sort as the column does; the names of these fields.

    Fields: whether it is NULL, where NaN belongs, then one signed value for each type that occurs.
    """
    types = {c: df.schema[c].dataType for c in directions}
    wide = {c: DecimalType(20, 0) if isinstance(t, IntegralType) else DoubleType() if isinstance(t, FloatType) else t for c, t in types.items()}
    for c, t in wide.items():
        if not isinstance(t, (DoubleType, DecimalType)):
            raise TypeError(f"{c} is {types[c].simpleString()}; only numbers are ranked")
    distinct = list(dict.fromkeys(t.simpleString() for t in wide.values()))
    structs = []
    for c, direction in directions.items():
        value = F.col(c).cast(wide[c])
        is_nan = F.isnan(value) if isinstance(wide[c], DoubleType) else F.lit(False)
        signed = F.when(~is_nan, -value if direction == 1 else value)
        fields = [
            F.lit(c).alias("_metric"),
            F.col(c).isNull().alias("_missing"),
            F.when(is_nan, F.lit(-direction)).otherwise(F.lit(0)).alias("_nan"),
            *[(signed if t == wide[c].simpleString() else F.lit(None)).cast(t).alias(f"_value{k}") for k, t in enumerate(distinct)],
        ]
        structs.append(F.struct(*fields))
    return structs, ["_missing", "_nan", *[f"_value{k}" for k in range(len(distinct))]]


def _same(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, (a.eqNullSafe(b) for a, b in zip(left, right)))


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"r{c}") for c in names], *[c for c in df.columns if c not in names])


def _by_split(df, group, directions, percent, suffix):
    structs, order = _comparable(df, directions)
    # rows that agree in group and values share their ranks, so these are all the identity that is needed
    alike = [group, *directions]
    rows = df.groupBy(*alike).agg(F.count(F.lit(1)).alias("_n"))
    keys = [f"_key{k}" for k in range(len(alike))]
    long = rows.select(*[F.col(c).alias(k) for c, k in zip(alike, keys)], F.col(group).alias("_group"), "_n", F.inline(F.array(*structs)))
    counted = long.groupBy("_group", "_metric", *order).agg(F.sum("_n").alias("_n"))

    at = ["_group", "_metric"]
    place = F.struct(*order)  # compares field by field, NULL lowest, as the sort inside a bucket does
    cuts = _renamed(cuts_by_hash(counted, at, place, BUCKETS), at)
    bucketed = counted.join(cuts, _same([F.col(c) for c in at], [F.col(f"r{c}") for c in at]), "left")
    bucketed = bucketed.select(*at, *order, "_n", bucket_of(place).alias("_bucket"))

    per_bucket = bucketed.groupBy(*at, "_bucket").agg(F.sum("_n").alias("_in_bucket"))
    by_metric = Window.partitionBy(*at)
    earlier_buckets = by_metric.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.select(
        *at,
        "_bucket",
        F.coalesce(F.sum("_in_bucket").over(earlier_buckets), F.lit(0)).alias("_before"),
        F.sum("_in_bucket").over(by_metric).alias("_rows"),
    )
    inside = Window.partitionBy(*at, "_bucket").orderBy(*order)
    better = F.coalesce(F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_bucket = _renamed(per_bucket, [*at, "_bucket"])
    in_bucket = [*at, "_bucket"]
    placed = bucketed.withColumn("_better", better).join(per_bucket, _same([F.col(c) for c in in_bucket], [F.col(f"r{c}") for c in in_bucket]))
    ahead = F.col("_before") + F.col("_better")
    if percent:
        share = F.when(F.col("_rows") > 1, ahead.cast("double") / (F.col("_rows") - 1).cast("double")).otherwise(F.lit(0.0))
        rank = F.when(~F.col("_missing"), share)
    else:
        rank = (ahead + 1).cast("int")
    value = [*at, *order]
    ranks = _renamed(placed.select(*value, rank.alias("_rank")), value)
    # as many as distinct values: a broadcast's size is estimated from packed rows, and the driver would hold it unpacked
    ranked = long.join(ranks.hint("merge"), _same([F.col(c) for c in value], [F.col(f"r{c}") for c in value]))
    wide = ranked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_metric") == c, F.col("_rank"))).alias(f"{c}{suffix}") for c in directions]
    )
    return df.join(wide.hint("merge"), _same([F.col(c) for c in alike], [F.col(k) for k in keys])).drop(*keys)
