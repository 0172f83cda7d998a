"""Table and CSV sinks.

Tables are replaced in two steps: all rows are written beside the table, then the
names are swapped. A run that fails leaves the former table as it was.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: the folder name of a NULL partition value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it is there."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").where("col_name = 'Location'").first()["data_type"]


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(_quoted(name)) if c.isPartition]


def _rename(spark: SparkSession, name: str, to: str) -> None:
    """Rename a table; its partitions follow, which not every catalog sees to."""
    spark.sql(f"ALTER TABLE {_quoted(name)} RENAME TO {_quoted(to)}")
    if not _partition_columns(spark, to):
        return
    folder = _location(spark, to)
    for (fragment,) in spark.sql(f"SHOW PARTITIONS {_quoted(to)}").collect():  # one row a partition
        pairs = (part.split("=", 1) for part in fragment.split("/"))
        spec = ", ".join(f"`{c}` = " + ("null" if v == _NO_VALUE else "'" + unquote(v).replace("\\", "\\\\").replace("'", "\\'") + "'") for c, v in pairs)
        spark.sql(f"ALTER TABLE {_quoted(to)} PARTITION ({spec}) SET LOCATION '{folder}/{fragment}'")
    spark.catalog.refreshTable(_quoted(to))


def stage_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), bucket_by: tuple[int, str] | None = None
) -> str:
    """Write a catalog table beside ``name`` and return its own name; nothing stays if that fails."""
    spark, staged = df.sparkSession, f"{name}__staged"
    if partition_by and bucket_by is None:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    try:
        writer.saveAsTable(_quoted(staged))
    except BaseException:
        drop_table(spark, staged)
        raise
    return staged


def publish_tables(spark: SparkSession, staged: Mapping[str, str]) -> None:
    """Give staged tables (name -> staged name) their names; if one can't be renamed, the former tables come back."""
    former = {name: f"{name}__former" for name in staged if spark.catalog.tableExists(_quoted(name))}
    moved: list[str] = []
    named: list[str] = []
    try:
        for name, beside in former.items():
            drop_table(spark, beside)
            _rename(spark, name, beside)
            moved.append(name)
        for name, beside in staged.items():
            _rename(spark, beside, name)
            named.append(name)
    except BaseException:
        for name in named:
            drop_table(spark, name)
        for name in moved:
            _rename(spark, former[name], name)
        raise
    for beside in former.values():
        drop_table(spark, beside)


def save_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
    keep_other_partitions: bool = False,
) -> None:
    """Write a catalog table, replacing what is there; ``df`` may read it.

    ``partition_by`` lays rows out by those columns; the rebalance hint lets AQE
    split a large partition over several writers instead of one.
    ``bucket_by`` (number, column) keeps later joins and groupings on the column
    free of a shuffle. ``keep_other_partitions`` replaces only the partitions
    that occur in ``df`` (existing, partitioned table).
    """
    spark = df.sparkSession
    if keep_other_partitions and spark.catalog.tableExists(_quoted(name)):
        _replace_partitions(df, name)
        return
    publish_tables(spark, {name: stage_table(df, name, partition_by, bucket_by)})


def _replace_partitions(df: DataFrame, name: str) -> None:
    """Overwrite only the partitions that occur in ``df``, as an option of this write alone.

    The writer fills a folder of its own and moves whole partitions when all rows are there.
    """
    spark, table = df.sparkSession, df.sparkSession.table(_quoted(name))
    parts = _partition_columns(spark, name)
    if not parts:
        raise ValueError(f"{name} has no partitions")
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields]).hint("rebalance", *[F.col(c) for c in parts])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(_location(spark, name))
    spark.catalog.recoverPartitions(_quoted(name))
    spark.catalog.refreshTable(_quoted(name))


def replace_partitions(df: DataFrame, name: str, values: Mapping[str, Sequence[int]]) -> None:
    """Make ``df`` the whole content of the partitions that hold the given values of one partition column.

    Those without a row in ``df`` are dropped; partitions of other values stay as they are.
    """
    spark = df.sparkSession
    ((column, wanted),) = values.items()
    present = {r[0] for r in df.select(column).distinct().collect()}  # one row a partition
    if present - set(wanted):
        raise ValueError(f"rows of other partitions than {column} = {sorted(wanted)}")
    if present:
        _replace_partitions(df, name)
    for value in sorted(set(wanted) - present):
        spark.sql(f"ALTER TABLE {_quoted(name)} DROP IF EXISTS PARTITION (`{column}` = {int(value)})")
    spark.catalog.refreshTable(_quoted(name))


def export_csv(df: DataFrame, path: str) -> None:
    """Write CSV part files with a header, in parallel."""
    df.write.mode("overwrite").option("header", True).csv(path)
