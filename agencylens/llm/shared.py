"""Helpers that several operators share: reading, packing rows, cutting lineage, bounded broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Largest pickled object that the operators broadcast, in bytes.
BROADCAST_BYTES = 64 << 20

#: Words: runs of anything but ASCII white space.
SPACED_WORDS = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, keep: list[str] | None = None, **inputs: Column) -> DataFrame:
    """The kept columns (all by default) in one struct `doc` beside the operator's inputs, so that no name can clash."""
    names = df.columns if keep is None else keep
    return df.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("doc"), *(c.alias(n) for n, c in inputs.items()))


def unpacked(df: DataFrame) -> DataFrame:
    """The original rows of a packed frame."""
    return df.select("doc.*")


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: the session's spark.checkpoint.dir.

    Where that is unset, a local session gets a folder of its own; elsewhere that is an error.
    """
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return context.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """The rows, checkpointed in the shared folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder as Parquet and read again."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4()}"
    df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    rows.stored_at = path
    return rows


def discard(*frames: DataFrame) -> None:
    """Deletes what `stored` wrote for these frames, which nothing may read any more."""
    for df in frames:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


class Shipped:
    """A broadcast value; `value` unpickles it, so a task reads it once."""

    def __init__(self, spark: SparkSession, pickled: bytes) -> None:
        self._broadcast = spark.sparkContext.broadcast(pickled)

    @property
    def value(self) -> object:
        return cloudpickle.loads(self._broadcast.value)


def shipped(spark: SparkSession, value: object, what: str) -> Shipped:
    """A broadcast of a value that takes at most BROADCAST_BYTES pickled; more is an error."""
    pickled = cloudpickle.dumps(value)
    if len(pickled) > BROADCAST_BYTES:
        raise ValueError(f"{what} takes {len(pickled)} bytes; at most {BROADCAST_BYTES} are broadcast")
    return Shipped(spark, pickled)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text, modulo 4, is 2. A null id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))
