"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length; per source, a bounded knapsack over these counts fits the budget; documents are
then picked by seeded rank within source and length. A source's share in words decides how often every document is taken
(0, 1 or 2 times); what is left of the budget is met by some documents once more: the same proportion of every length
first, then the longest lengths that fit, and last, when what is left is below `exact_budget`, dynamic programming over
sums of the lengths not yet used up, each at most as often as it is left.

Only counts by (source, length) meet in one task per source: as many rows as the source has lengths. Ranks are taken in
bins of a hash, so equal lengths of a hot source are never ordered by one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from agencylens.llm.shared import SPACED_WORDS, cut, packed

#: Fixed values of the recipe: weights by source in order, share of all words, largest multiple of a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: The last fit is exact dynamic programming over sums up to so many words.
EXACT_BUDGET = 1 << 16
#: A source and length's documents are ranked in so many bins.
BINS = 64
SEED = 20240607


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Of (source, source_size): the target of each source, in words.

    Sources by code point, null last, have the weights in turn. A target stops at `most` times the source's size and the
    excess goes to the others by weight: the level is that of filling vessels in the order in which they get full. Windows
    over all sources: a row for each source, not for documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))
    weighed = weighed.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    budget = F.sum("source_size").over(everything) * F.lit(share)
    levels = weighed.withColumn("level", (budget - before) / rest)
    level = F.max("level").over(everything)
    return levels.withColumn("target", F.least("cap", F.col("weight") * level)).select("source", "source_size", "target")


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, exact_budget: int = EXACT_BUDGET) -> np.ndarray:
    """How many documents of each length (at most its count) make up the budget, as nearly as the method gets without exceeding it.

    lengths: positive and distinct.
    """
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = counts * budget // total if total < 1 << 31 else np.array([int(c) * budget // total for c in counts], np.int64)
    left = budget - int((lengths * taken).sum())
    order = np.argsort(-lengths)
    for k in order:
        if left <= exact_budget:
            break
        more = min(int(counts[k] - taken[k]), (left - exact_budget) // int(lengths[k]) + 1, left // int(lengths[k]))
        taken[k] += more
        left -= more * int(lengths[k])
    # sums reachable with the lengths so far; spare[s]: how few of the latest length sum s took
    reached = np.zeros(left + 1, bool)
    reached[0] = True
    steps: list[tuple[int, np.ndarray]] = []
    for k in order:
        if reached[left]:
            break
        length, have = int(lengths[k]), int(counts[k] - taken[k])
        if not have or length > left:
            continue
        used = _used(reached, length, have)
        fresh = np.flatnonzero(used)
        if len(fresh):
            steps.append((int(k), used))
            reached |= used > 0
    at = int(np.flatnonzero(reached)[-1])
    for k, used in reversed(steps):
        n = int(used[at])
        taken[k] += n
        at -= n * int(lengths[k])
    return taken


def _used(reached: np.ndarray, length: int, have: int) -> np.ndarray:
    """For each sum that the length makes newly reachable: with how many of it; else 0. Chains of equal remainder run down the columns."""
    n = len(reached)
    rows = -(-n // length)
    grid = np.zeros(rows * length, bool)
    grid[:n] = reached
    grid = grid.reshape(rows, length)
    place = np.where(grid, np.arange(rows)[:, None], -1)
    last = np.maximum.accumulate(place, axis=0)
    gap = np.arange(rows)[:, None] - last
    used = np.where((last >= 0) & (gap > 0) & (gap <= have), gap, 0).reshape(-1)[:n]
    return used.astype(np.int32)


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    target, source_size = float(pdf["target"].iloc[0]), int(pdf["source_size"].iloc[0])
    budget = round(target)
    every = min(budget // source_size, MOST) if source_size else 0
    own = pdf["size"].to_numpy(np.int64)
    more = np.zeros(len(pdf), np.int64)
    filled = own > 0
    if filled.any() and every < MOST:
        more[filled] = fit(own[filled], pdf["n"].to_numpy(np.int64)[filled], budget - every * source_size)
    return pdf[["source", "size", "source_size", "target"]].assign(every=every, more=more)


def mixed(docs: DataFrame, keep: list[str] | None = None, seed: int = SEED, bins: int = BINS) -> DataFrame:
    """For every document (struct `doc` of the kept columns): size, source_size, target, copies.

    copies: how often the mix takes the document, 0 to 2. A document without words is taken as often as every document of
    its source is; null texts have size 0. The choice follows a hash of doc_id and the seed, so reruns agree; rows with
    equal doc_id are told apart by all their kept columns.
    """
    rows = packed(docs, keep, source=F.col("source").cast("string"), size=n_words(F.col("text")), key=F.xxhash64(F.lit(seed), F.col("doc_id")))
    rows = rows.withColumn("bin", F.shiftright("key", 56).cast("int") % F.lit(bins))
    light = rows if keep is None else cut(rows)  # the lengths, once; whole rows are not stored again
    by_bin = cut(light.groupBy("source", "size", "bin").agg(F.count(F.lit(1)).alias("n")))
    by_length = by_bin.groupBy("source", "size").agg(F.sum("n").alias("n"))
    by_source = by_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = targets(by_source)
    counted = by_length.join(goals.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    plan = counted.groupBy("source").applyInPandas(_plan, "source string, size long, source_size long, target double, every long, more long")
    lower = Window.partitionBy("source", "size").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bin.withColumn("before", F.coalesce(F.sum("n").over(lower), F.lit(0).cast("long")))
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source")) & (F.col(f"{a}.size") == F.col(f"{b}.size"))
    share = offsets.alias("o").join(plan.alias("p"), same("o", "p")).select("o.source", "o.size", "o.bin", "source_size", "target", "every", (F.col("more") - F.col("before")).alias("quota"))
    joined = light.alias("r").join(share.alias("s"), same("r", "s") & (F.col("r.bin") == F.col("s.bin")))
    joined = joined.select("doc", "r.source", "r.size", "r.bin", "key", "source_size", "target", "every", "quota")
    rank = F.row_number().over(Window.partitionBy("source", "size", "bin").orderBy("key", "doc"))
    return joined.select("doc", "size", "source_size", "target", (F.col("every") + (rank <= F.col("quota")).cast("long")).alias("copies"))


def mixing_report(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, size, source_size, target, taken."""
    mix = mixed(docs, keep=["doc_id"])
    return mix.select("doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def taken(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken."""
    mix = mixed(docs).filter(F.col("copies") > 0)
    return mix.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
