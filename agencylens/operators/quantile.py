"""Exact quantiles of groups of any size, by distributed selection.

Two ways to the same values. ``bracketed_quantiles`` takes any number of quantiles
in two readings of its input: a mergeable sketch, evaluated once, brackets each
wanted rank; what lies below, inside and above is counted, and only the distinct
values inside are sorted. ``exact_quantiles`` needs no sketch and reads its input
sixteen times:

Equal values are counted map-side first. The distinct values with the smallest
hashes then cut a group into buckets, the buckets' counts say which one holds the
wanted rank, and only that one goes on. A bucket has a few hundredths of its
group's distinct values, so ``LEVELS`` rounds leave some ten-thousandths for one
task to sort.

Where the cuts lie never changes the result, but they are read twice, so they
must be the same each time. A choice by hash is; a quantile sketch is not, since
it depends on the order in which its parts are merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegralType, LongType

BUCKETS, LEVELS = 256, 2

# A sketch's rank is off by 1 / SKETCH_ACCURACY of the rows at most, and a
# bracket reaches MARGIN times as far to each side. Its width never changes a result.
SKETCH_ACCURACY, MARGIN = 10_000, 4

_AT = ("_group", "_column")


def exact_quantiles(df: DataFrame, columns: Sequence[str], quantile: float, group: str | None = None, buckets: int = BUCKETS, levels: int = LEVELS) -> DataFrame:
    """The columns' quantiles, a row per group, columns ``_group`` and ``columns``; without a group one row without ``_group``.

    The quantile is the smallest value that at least this share of the group's
    values does not exceed. NULL is no value, NaN the largest; a column without
    any value in a group gives NULL, and a group in which no column has one has no
    row. NULL is a group. Columns are whole numbers, floating numbers, or
    decimals of one type.
    """
    if not 0 <= quantile <= 1:
        raise ValueError(f"quantile {quantile} is not between 0 and 1")
    if buckets < 2 or levels < 1:
        raise ValueError("at least two buckets and one level are needed")
    wide = _common_type(df, columns)
    key = F.lit(0) if group is None else F.col(group)
    cells = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast(wide).alias("_value")) for c in columns])
    long = df.select(key.alias("_group"), F.inline(cells)).where(F.col("_value").isNotNull())
    rows = long.groupBy(*_AT, "_value").agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.withColumn("_rank", F.lit(None).cast("long"))
    for _ in range(levels):
        rows = _bucket_of_rank(rows, quantile, buckets)
    found = _holding_rank(rows, "_value").select(*_AT, "_value")
    picked = [F.max(F.when(F.col("_column") == c, F.col("_value"))).cast(df.schema[c].dataType).alias(c) for c in columns]
    return found.agg(*picked) if group is None else found.groupBy("_group").agg(*picked)


def bracketed_quantiles(df: DataFrame, wanted: Mapping[str, tuple[str, float]], group: str | None = None, whole: Column | None = None) -> DataFrame:
    """Quantiles by name, each of a (column, quantile): a row per group, columns ``_group`` and the names; without a group one row.

    Quantiles, values and groups are those of ``exact_quantiles``, except that a
    group in which no column has a value has a row of NULLs. About a thousandth of a
    group's distinct values reach the task that sorts them. A rank outside its
    bracket, which the sketch rules out, is an error.

    With ``whole``, both readings compute this number of every row; ``_read`` is its
    maximum. It keeps a reading from being narrowed, so that both are of one shuffle.
    """
    for _, quantile in wanted.values():
        if not 0 <= quantile <= 1:
            raise ValueError(f"quantile {quantile} is not between 0 and 1")
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    wide = _common_type(df, columns)
    read = F.lit(0).cast("long") if whole is None else whole
    key = F.lit(0) if group is None else F.col(group)

    def place(column: str) -> Column:
        """Never falls as the value rises, and is no NaN."""
        value = F.col(column).cast("double")
        return F.nanvl(value, F.lit(float("inf")))

    reach = MARGIN / SKETCH_ACCURACY
    ends = [F.percentile_approx(place(c), [max(0.0, q - reach), min(1.0, q + reach)], SKETCH_ACCURACY).alias(n) for n, (c, q) in wanted.items()]
    rows = df if group is None else df.groupBy(key.alias("_for"))
    brackets = rows.agg(F.struct(*ends, F.max(read).alias("_read")).alias("_ends"))
    met = F.col("_ends._read").isNotNull()
    if group is None:
        met_rows = df.join(F.broadcast(brackets), met)  # one row
    else:
        met_rows = df.join(brackets, key.eqNullSafe(F.col("_for")) & met)

    def cell(name: str, column: str) -> Column:
        low, high = (F.col("_ends").getField(name).getItem(i) for i in range(2))
        side = F.when(F.col(column).isNotNull(), F.when(place(column) < low, -1).when(place(column) > high, 1).otherwise(0))
        return F.struct(F.lit(name).alias("_name"), side.alias("_side"), F.when(side == 0, F.col(column).cast(wide)).alias("_value"))

    long = met_rows.select(key.alias("_group"), read.alias("_read"), F.inline(F.array(*[cell(n, c) for n, (c, _) in wanted.items()])))
    counted = long.groupBy("_group", "_name", "_side", "_value").agg(F.count(F.lit(1)).alias("_n"), F.max("_read").alias("_read"))
    counted = counted.withColumn("_n", F.when(F.col("_side").isNotNull(), F.col("_n")).otherwise(0))
    own = Window.partitionBy("_group", "_name")
    so_far = F.sum("_n").over(own.orderBy("_side", "_value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counted.withColumns({"_so_far": so_far, "_all": F.sum("_n").over(own)})
    picked = []
    for name, (column, quantile) in wanted.items():
        # exact: a decimal share of a whole number
        rank = F.greatest(F.ceil(F.lit(Decimal(str(quantile))) * F.col("_all")).cast("long"), F.lit(1).cast("long")) - (F.col("_so_far") - F.col("_n"))
        value = F.when(F.col("_side") == 0, F.col("_value")).otherwise(F.raise_error(F.lit(f"the sketch missed quantile {name}")).cast(wide))
        picked.append(F.max(F.when((F.col("_name") == name) & rank.between(1, F.col("_n")), value)).cast(df.schema[column].dataType).alias(name))
    if whole is not None:
        picked.append(F.max("_read").alias("_read"))
    return ranked.agg(*picked) if group is None else ranked.groupBy("_group").agg(*picked)


def _common_type(df: DataFrame, columns: Sequence[str]) -> DataType:
    types = [df.schema[c].dataType for c in columns]
    if all(isinstance(t, IntegralType) for t in types):
        return LongType()
    if all(isinstance(t, (FloatType, DoubleType)) for t in types):
        return DoubleType()
    if all(isinstance(t, DecimalType) and t == types[0] for t in types):
        return types[0]
    raise TypeError(f"{', '.join(columns)} are not numbers of one kind")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> tuple[DataFrame, Column]:
    """The right side under names of its own, and the condition that joins it; NULL equals NULL."""
    renamed = right.withColumnsRenamed({c: f"_r{c}" for c in names})
    condition = F.lit(True)
    for c in names:
        condition = condition & left[c].eqNullSafe(renamed[f"_r{c}"])
    return renamed, condition


def _holding_rank(rows: DataFrame, order: str) -> DataFrame:
    """Of every group and column, the row within whose count ``_n`` the rank falls; ``_rank`` becomes the rank inside it."""
    so_far = F.sum("_n").over(Window.partitionBy(*_AT).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.withColumn("_rank", F.col("_rank") - (so_far - F.col("_n")))
    return placed.where(F.col("_rank").between(1, F.col("_n")))


def cuts_by_hash(rows: DataFrame, at: Sequence[str], value: Column, buckets: int) -> DataFrame:
    """Columns ``at`` and ``_cuts``: of each group, ``buckets - 1`` distinct values at most, sorted.

    ``rows`` hold each value of a group once. Spark cuts every map partition to
    that many before the shuffle (WindowGroupLimit).
    """
    chosen = Window.partitionBy(*at).orderBy(F.xxhash64("_cut"), "_cut")
    few = rows.select(*at, value.alias("_cut")).withColumn("_turn", F.row_number().over(chosen)).where(F.col("_turn") < buckets)
    return few.groupBy(*at).agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))


def bucket_of(value: Column) -> Column:
    """Number of cuts below the value, which never falls as the value rises."""
    return F.size(F.filter("_cuts", lambda cut: cut < value))


def _bucket_of_rank(rows: DataFrame, quantile: float, buckets: int) -> DataFrame:
    """The rows (value, count) of the bucket that holds the rank, with the rank inside it; a NULL rank is still to be found."""
    known, alike = _same(rows, cuts_by_hash(rows, _AT, F.col("_value"), buckets), _AT)
    dealt = rows.join(known, alike).select(*_AT, "_value", "_n", "_rank", bucket_of(F.col("_value")).alias("_bucket"))
    # at most `buckets` rows for each group and column reach these windows
    counted = dealt.groupBy(*_AT, "_bucket").agg(F.sum("_n").alias("_n"), F.max("_rank").alias("_rank"))
    # exact: a decimal share of a whole number
    wanted = F.ceil(F.lit(Decimal(str(quantile))) * F.sum("_n").over(Window.partitionBy(*_AT))).cast("long")
    ranked = counted.withColumn("_rank", F.coalesce("_rank", F.greatest(wanted, F.lit(1).cast("long"))))
    chosen = _holding_rank(ranked, "_bucket").select(*_AT, "_bucket", "_rank")
    kept, alike = _same(dealt, chosen, (*_AT, "_bucket"))
    return dealt.drop("_rank").join(kept, alike).select(*_AT, "_value", "_n", "_rank")
