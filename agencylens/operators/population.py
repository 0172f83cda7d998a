"""Which entities belong to an analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def entity_population(snapshot: DataFrame, start_period: int, segments: Sequence[int]) -> DataFrame:
    """Distinct entities seen in one of the segments after ``start_period``."""
    seen = (F.col("period") > start_period) & F.col("segment").isin(list(segments))
    return snapshot.where(seen & F.col("entity_id").isNotNull()).select("entity_id").distinct()


def restrict_to(df: DataFrame, population: DataFrame, on: str | list[str] = "entity_id", prefilter_bits: int | None = None) -> DataFrame:
    """Rows whose key occurs in the population; never multiplies rows.

    With ``prefilter_bits`` most other rows go before the exchange by key, for a
    selective population that is too large to broadcast; the result is the same.
    """
    rows = df if prefilter_bits is None else possible_members(df, population, on, prefilter_bits)
    return rows.join(population, on=on, how="left_semi")


def possible_members(df: DataFrame, population: DataFrame, on: str | list[str] = "entity_id", bits: int = 1 << 24) -> DataFrame:
    """Rows whose key may occur in the population: all that do, and few others.

    The population becomes one Bloom filter of ``bits`` bits with one hash, which
    is broadcast as a mask for each run of 64 bits: ``bits / 64`` rows at most,
    whatever the population's size. About one other key in ``bits / size`` stays.
    """
    keys = [on] if isinstance(on, str) else list(on)
    for key in keys:
        if df.schema[key].dataType != population.schema[key].dataType:
            raise TypeError(f"{key} has two types, which hash differently")
    place = F.pmod(F.xxhash64(*keys), F.lit(bits).cast("long"))
    run, bit = F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    masks = population.select(run.alias("_run"), bit.alias("_bit")).groupBy("_run").agg(F.bit_or("_bit").alias("_mask"))
    return df.join(F.broadcast(masks), (run == F.col("_run")) & (F.col("_mask").bitwiseAND(bit) != 0), "left_semi")


def entry_population(
    snapshot: DataFrame,
    period: int,
    departments: Sequence[int],
    segment: int = 1,
    arrears: tuple[int, int] = (2, 6),
) -> DataFrame:
    """One row per entity entering at ``period``, with its department.

    An entity with several departments keeps the lowest one, so the choice is
    repeatable.
    """
    return (
        snapshot.where(is_entry_record(period, departments, segment, arrears))
        .groupBy("entity_id")
        .agg(F.min("department").alias("department"))
    )


def is_entry_record(period: int, departments: Sequence[int], segment: int = 1, arrears: tuple[int, int] = (2, 6)):
    """Condition that makes a snapshot record an entry record."""
    return (
        (F.col("period") == period)
        & (F.col("segment") == segment)
        & F.col("department").isin(list(departments))
        & F.col("arrears").between(*arrears)
    )
