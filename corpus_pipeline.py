"""The corpus pipeline: stages over `documents`, each written as Parquet and read again by the next.

toxicity         documents that score as toxic go
near duplicates  one document of each group of near copies stays
decontamination  documents that hold a benchmark window go
mixing           every document as often as the mix of sources takes it, 0 to 2 times
sharding         shard and slot of every row of the mix

All stages but the last return the columns of their input. Rows that repeat a doc_id in the mix share a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agencylens.llm import decontaminate, mixing, sharding, similar, toxicity
from agencylens.llm.shared import stored, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.taken(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_report(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: No SQL: a trained model and 64-bit fingerprints are beyond it; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
