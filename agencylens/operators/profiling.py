"""Data-set checks: value frequencies and a per-column profile.

The profile counts values by 128 bits of the typed value, so a long text costs as
much as a number. Equal values meet map-side: one that fills a third of a column
is one row per task when it is shuffled, and so are a column's NULLs. One scan
serves all columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType


def _comparable(value: Column, kind: DataType) -> Column:
    """A value of which equal ones, and only they, are alike: -0.0 as 0.0, maps as entries sorted by key, at any depth."""
    if isinstance(kind, (DoubleType, FloatType)):
        return F.when(value == 0, F.lit(0.0).cast(kind)).otherwise(value)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _comparable(x, kind.elementType))
    if isinstance(kind, StructType):
        fields = F.struct(*(_comparable(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields))
        return F.when(value.isNotNull(), fields)
    if isinstance(kind, MapType):
        entry = StructType().add("key", kind.keyType).add("value", kind.valueType)
        # keys are unique, so the order of the entries is that of the keys' hashes
        hashed = F.transform(F.map_entries(value), lambda e: F.struct(F.xxhash64(e["key"]).alias("rank"), _comparable(e["key"], entry["key"].dataType).alias("key"), _comparable(e["value"], entry["value"].dataType).alias("value")))
        return F.array_sort(hashed, lambda a, b: F.when(a["rank"] < b["rank"], -1).when(a["rank"] > b["rank"], 1).otherwise(0))
    return value


def _text(df: DataFrame, name: str) -> Column:
    """A value's text, equal for equal values only; nested values as JSON that shows NULL."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.when(value.isNotNull(), F.to_json(F.struct(_comparable(value, kind).alias(name)), {"ignoreNullFields": "false"}))
    return _comparable(value, kind).cast("string")


def _digest(df: DataFrame, name: str) -> Column:
    """128 bits of a value, NULL for NULL: two hashes of the typed value, of nested ones of their text."""
    kind, value = df.schema[name].dataType, F.col(name)
    plain = _text(df, name) if isinstance(kind, (ArrayType, MapType, StructType)) else _comparable(value, kind)
    return F.when(value.isNotNull(), F.struct(F.xxhash64(plain).alias("a"), F.xxhash64(F.lit(1), plain).alias("b")))


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    texts = df.select(*[_text(df, c).alias(c) for c in columns])
    pairs = texts.unpivot([], list(columns), "column", "value")
    return pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, most frequent first."""
    return _value_counts(df, columns).orderBy("column", F.desc("n"), "value")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """NULLs, distinct values, non-NULLs and share of NULLs per column.

    ``method="sketch"`` estimates the distinct values by mergeable sketches: one
    scan without a row per value, within a percent or so.
    """
    columns = list(columns or df.columns)
    if method not in ("exact", "sketch"):
        raise ValueError(f"unknown method {method!r}")
    numbers = [str(k) for k in range(len(columns))]
    digests = df.select(*[_digest(df, c).alias(k) for k, c in zip(numbers, columns, strict=True)])
    if method == "sketch":
        sketches = [F.hll_sketch_estimate(F.hll_sketch_agg(F.col(k)["a"], F.lit(14))).alias(f"distinct_{k}") for k in numbers]
        totals = digests.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(k)).alias(f"non_nulls_{k}") for k in numbers], *sketches)
        fields = [
            F.struct((F.col("n_rows") - F.col(f"non_nulls_{k}")).alias("nulls"), F.col(f"distinct_{k}").alias("distinct"), F.col(f"non_nulls_{k}").alias("non_nulls"), F.lit(k).alias("at"))
            for k in numbers
        ]
        per_column = totals.where("n_rows > 0").select(F.inline(F.array(*fields)))
    else:
        values = digests.unpivot([], numbers, "at", "value")
        counts = values.groupBy("at", F.col("value.a").alias("a"), F.col("value.b").alias("b")).agg(F.count(F.lit(1)).alias("n"))
        missing = F.col("a").isNull()
        per_column = counts.groupBy("at").agg(
            F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("nulls"), F.count("a").alias("distinct"), F.sum(F.when(missing, 0).otherwise(F.col("n"))).alias("non_nulls")
        )
    share = F.round(F.col("nulls") / (F.col("nulls") + F.col("non_nulls")).cast("double") * 100, 2)
    named = per_column.withColumn("column", F.element_at(F.array(*map(F.lit, columns)), F.col("at").cast("int") + 1))
    return named.select("column", "nulls", "distinct", "non_nulls", share.alias("pct_nulls")).orderBy(F.desc("nulls"), "column")


def row_and_key_totals(df: DataFrame, key: str = "agency") -> DataFrame:
    """Row count and distinct keys as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_distinct_keys"))
