"""Data-set check: totals, value frequencies and column profile."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from ..operators.profiling import column_profile, row_and_key_totals, value_frequencies

CHECKED_COLUMNS = ("segment", "status", "agency_type", "management_type", "interface_enabled")


class DatasetCheck(NamedTuple):
    """Three lazy reports on one data set."""

    totals: DataFrame
    frequencies: DataFrame
    profile: DataFrame


def check_dataset(df: DataFrame, key: str = "agency", columns: Sequence[str] = CHECKED_COLUMNS) -> DatasetCheck:
    """Row and key totals, value frequencies of the given columns, profile of all."""
    present = [c for c in columns if c in df.columns]
    return DatasetCheck(row_and_key_totals(df, key), value_frequencies(df, present), column_profile(df))
