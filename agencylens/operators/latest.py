"""Last record per key.

Ties on the ordering columns are broken by ``tie_break`` so that re-running a
task after an executor is lost picks the same record again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    """Whole last row per key; NULL ordering values come last.

    Spark cuts every map partition to one row per key before the shuffle
    (WindowGroupLimit), so a key that holds a third of the rows stays cheap.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in (*order_by, *tie_break)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def ranked_record(order_by: Sequence[str], tie_break: Sequence[str], take: Sequence[str]) -> Column:
    """Struct whose maximum over a group is the group's last record.

    Fields are the ordering, the tie-break, then the payload, so even full ties
    resolve the same way every time. NULL sorts lowest inside a struct, as it
    does last in descending order.
    """
    return F.struct(*[F.col(c) for c in dict.fromkeys((*order_by, *tie_break, *take))])


def latest_with_aggregates(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    take: Sequence[str],
    aggregates: Sequence[Column],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Columns ``take`` of the last row per key, plus aggregates over all rows of the key.

    One pass and one shuffle: the last record is a maximum, which combines
    map-side like the sums do.
    """
    grouped = df.groupBy(*keys).agg(F.max(ranked_record(order_by, tie_break, take)).alias("_last"), *aggregates)
    return grouped.select("*", *[F.col("_last").getField(c).alias(c) for c in take]).drop("_last")
