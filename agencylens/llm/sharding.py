"""Shards by jump consistent hashing: a key and the shard count decide, and an appended shard only takes rows into itself.

DataFrame functions only. The hash has no table: a 64-bit linear congruential generator, seeded by the key, jumps over
the shard counts at which the key would move; the last jump within the count is the shard. Every draw moves at least one
shard on, so `n_shards` draws are always enough; about log(n_shards) are usual, so 64 are made for every row and the full
number only for a row that has not arrived by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Fixed value: the multiplier of the published generator.
MULTIPLIER = 2862933555777941757
USUAL_DRAWS = 64
#: Rows of a shard are numbered in so many bins; one task numbers a bin, not a shard.
BINS = 1024


def key_words(key: Column) -> tuple[Column, Column]:
    """High and low 32 bits of a key's seed: the start of the MD5 of its text (null: of the empty text)."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    word = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    return word(1), word(9)


def _draw(high: Column, low: Column) -> tuple[Column, Column]:
    """The next state, in products of 32 by 16 bits, none of which leaves a long."""
    m_high, m_low_high, m_low_low = MULTIPLIER >> 32, (MULTIPLIER >> 16) & 0xFFFF, MULTIPLIER & 0xFFFF
    mask = F.lit(0xFFFFFFFF).cast("long")
    times = lambda c, m: c * F.lit(m).cast("long")
    middle = times(low, m_low_high)
    bottom = times(low, m_low_low) + F.shiftleft(middle.bitwiseAND(F.lit(0xFFFF).cast("long")), 16) + F.lit(1).cast("long")
    top = (
        F.shiftright(bottom, 32)
        + F.shiftright(middle, 16)
        + times(low, m_high).bitwiseAND(mask)
        + times(high, m_low_low)
        + F.shiftleft(times(high, m_low_high).bitwiseAND(F.lit(0xFFFF).cast("long")), 16)
    )
    return top.bitwiseAND(mask), bottom.bitwiseAND(mask)


def jump_shard(high: Column, low: Column, n_shards: int) -> Column:
    """Shard 0 to n_shards - 1 of a key's seed."""
    if n_shards < 1:
        raise ValueError("there must be at least one shard")
    long = lambda x: F.lit(x).cast("long")

    def step(state: Column, _: Column) -> Column:
        new_high, new_low = _draw(state["high"], state["low"])
        jump = F.floor((state["next"] + long(1)).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(new_high, 1) + long(1)).cast("double")))
        moved = F.struct(new_high.alias("high"), new_low.alias("low"), state["next"].alias("shard"), jump.cast("long").alias("next"))
        return F.when(state["next"] < long(n_shards), moved).otherwise(state)

    def drawn(times: int) -> Column:
        start = F.struct(high.alias("high"), low.alias("low"), long(-1).alias("shard"), long(0).alias("next"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(times)), start, step)

    usual = drawn(min(n_shards, USUAL_DRAWS))
    if n_shards <= USUAL_DRAWS:
        return usual["shard"].cast("int")
    return F.when(usual["next"] >= long(n_shards), usual["shard"]).otherwise(drawn(n_shards)["shard"]).cast("int")


def sharded(df: DataFrame, key: str, n_shards: int = 8, bins: int = BINS) -> DataFrame:
    """Every row with its `shard`, its `slot` (0, 1, ... within the shard) and `grown_shard`, its shard if one were appended.

    Slots follow the key's hash. Bins of a shard are counted on the key column alone; the counts (n_shards x bins rows at
    most) give each bin's first slot, so no task sees a whole shard. A null key hashes as the empty text. Rows with equal
    keys share a shard; their slots follow the order of the whole row. All columns of `df` are in the struct `doc`.
    """
    high, low = key_words(F.col(f"`{key}`"))

    def placed(*columns: Column) -> DataFrame:
        seeded = df.select(*columns, high.alias("high"), low.alias("low"))
        return seeded.withColumn("shard", jump_shard(F.col("high"), F.col("low"), n_shards)).withColumn("bin", F.pmod("low", F.lit(bins)).cast("int"))

    counts = placed().groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("first"))
    rows = placed(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("doc"))
    rows = rows.withColumn("grown_shard", jump_shard(F.col("high"), F.col("low"), n_shards + 1))
    order = Window.partitionBy("shard", "bin").orderBy("high", "low", "doc")
    return (
        rows.join(F.broadcast(first), ["shard", "bin"])  # n_shards x bins rows at most
        .withColumn("slot", F.col("first") + F.row_number().over(order) - F.lit(1))
        .select("doc", "shard", "slot", "grown_shard")
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder of Parquet files for each shard, of the original rows; the rows of a shard are spread over tasks by their slot."""
    (
        assigned.withColumn("part", F.pmod(F.xxhash64("slot"), F.lit(64)))
        .repartition("shard", "part")
        .select("doc.*", F.col("shard").alias("_shard"))
        .write.partitionBy("_shard")
        .parquet(path)
    )


def shard_report(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """Digest of the documents' shards: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A null text has size 1 and the CRC of the empty text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharded(rows, "doc_id", n_shards).select("doc.doc_id", "doc.size", "doc.text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
