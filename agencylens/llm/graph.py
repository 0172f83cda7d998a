"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from agencylens.llm.shared import cut


#: Edges that one partition takes, where a table of edges is laid out by its number of rows.
ROWS = 1 << 20


def components(edges: DataFrame, most_rounds: int = 60, by_rows: bool = False) -> DataFrame:
    """(node, root) of every node on an edge (u, v), root being the component's smallest node.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node it sees, until nothing
    changes: a logarithmic number of rounds. A node's minimum is pre-aggregated and joined back, so a node with very many
    neighbours is never gathered. Edges are cut to the shared folder in every round.

    `by_rows` lays out the edges in a partition for every ROWS of them; where one is enough, no round shuffles.
    """
    larger, smaller = F.greatest("u", "v"), F.least("u", "v")
    current = cut(edges.filter(F.col("u") != F.col("v")).select(larger.alias("u"), smaller.alias("v")).distinct())
    parts = current.count() // ROWS + 1 if by_rows else None
    laid = lambda df: df.coalesce(parts) if by_rows else df
    current = laid(current)
    mark = _mark(current)
    for _ in range(most_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("root"))
        hung = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("root").alias("v")).distinct()
        hung = laid(cut(hung))
        least = hung.groupBy("u").agg(F.min("v").alias("root"))
        moved = hung.join(least, "u").filter(F.col("v") != F.col("root")).select(F.col("v").alias("u"), F.col("root").alias("v"))
        current = laid(cut(moved.unionByName(least.withColumnRenamed("root", "v")).distinct()))
        mark, before = _mark(current), mark
        if mark == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError(f"components still change after {most_rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.crc32(F.concat_ws(",", "u", "v").cast("binary")))).first())
