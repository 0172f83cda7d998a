"""Merkle manifest of a table: a tree of hashes for each source and one over the sources, with a proof for every row.

Checkpoint and recompute. Rows are hashed once; of the levels above only every third is stored. The nodes between two
stored levels lie in aligned subtrees of 27 stored descendants at most: building makes them and keeps the top, and proofs
make them again, emit each descendant's siblings and drop them. Work and storage above the rows shrink by 27 a stored level.

All of it is DataFrame functions. Places within a source come from one range shuffle of (source, key, hash), so a source
that holds a third of all rows is many tasks' work, and no task holds more than a subtree's hashes at once.

Null fields hash as `-`. Rows are ordered by key (null first), then by hash; rows that repeat both are leaves of their own,
alike but for their place. A null source is a source, before all others. A text of any length is one value of its row and
is read once. An empty table has no rows and no root. Only named columns are read, so further ones can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from agencylens.llm.shared import stored

#: Nodes of a run, and levels between two stored ones.
ARITY, EVERY = 3, 3
BLOCK = ARITY**EVERY
_PATH = "array<struct<before:string,after:string>>"


def hashed(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of the inputs, concatenated."""
    return F.sha2(F.concat(*inputs), 256)


def field(value: Column) -> Column:
    """A value's UTF-8 byte count, a colon and the value; `-` if it is null."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def _placed(leaves: DataFrame, *order: str) -> DataFrame:
    """Leaves (tree, hash, ...) with their `place` in the tree, by the given order, and the tree's `size`; stored.

    A partition of the range shuffle numbers its rows; places follow from the counts of (tree, partition), which are as many
    as trees and partitions together.
    """
    ranged = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    rows = stored(ranged.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    counts = rows.groupBy("tree", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("size"))
    places = rows.withColumn("part", part).join(offsets, ["tree", "part"])
    return places.withColumn("place", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _risen(below: Column) -> Column:
    """The next level: the hash of every run."""
    starts = F.sequence(F.lit(0), F.size(below) - 1, F.lit(ARITY))
    return F.transform(starts, lambda i: F.sha2(F.concat_ws("", F.slice(below, i + 1, ARITY)), 256))


def _subtrees(nodes: DataFrame, *carried: str) -> DataFrame:
    """(tree, block, size, own, depth, level_0 ... level_EVERY): each aligned subtree's nodes from its stored ones.

    `own` has (place, hash, carried columns) of the stored ones; `depth` is how many levels remain to be built, EVERY at most.
    """
    own = F.array_sort(F.collect_list(F.struct("place", "hash", *carried)))
    grouped = nodes.groupBy("tree", F.floor(F.col("place") / BLOCK).alias("block")).agg(own.alias("own"), F.first("size").alias("size"))
    depth = F.when(F.col("size") <= 1, 0)
    for levels in range(1, EVERY):
        depth = depth.when(F.col("size") <= ARITY**levels, levels)
    grown = grouped.withColumn("depth", depth.otherwise(EVERY)).withColumn("level_0", F.col("own.hash"))
    for k in range(EVERY):
        below = F.col(f"level_{k}")
        grown = grown.withColumn(f"level_{k + 1}", F.when(F.col("depth") > k, _risen(below)).otherwise(below))
    return grown


def _siblings(i: Column) -> Column:
    """The siblings of a subtree's i-th stored node, for each level within the subtree: those before and those after it."""
    steps = []
    for k in range(EVERY):
        at = F.floor(i / ARITY**k).cast("int")
        turn = at % ARITY
        joined = lambda start, n, k=k: F.concat_ws("", F.slice(f"level_{k}", start, n))
        steps.append(F.struct(joined(at - turn + 1, turn).alias("before"), joined(at + 2, F.lit(ARITY - 1) - turn).alias("after")))
    return F.slice(F.array(*steps), F.lit(1), F.col("depth"))


def built(leaves: DataFrame) -> list[DataFrame]:
    """The stored levels of placed leaves (tree, place, size, hash, ...), the last one holding each tree's root alone."""
    levels = [leaves]
    most = leaves.agg(F.max("size")).first()[0] or 0
    while most > 1:
        tops = _subtrees(levels[-1]).select("tree", F.col("block").alias("place"), F.ceil(F.col("size") / BLOCK).alias("size"), F.element_at(f"level_{EVERY}", 1).alias("hash"))
        levels.append(stored(tops))
        most = -(-most // BLOCK)
    return levels


def paths(levels: list[DataFrame], above: DataFrame, *carried: str) -> DataFrame:
    """(tree, place, hash, carried columns, path) of every node of the lowest level.

    `above` has (tree, path) of each tree's root: how it goes on to a tree of trees. A path has the siblings of every level,
    upwards. Columns of `above` beside these two are kept.
    """
    shared = [c for c in above.columns if c not in ("tree", "path")]
    upper = above.withColumn("block", F.lit(0).cast("long"))
    for k in range(len(levels) - 1, 0, -1):
        upper = _extended(levels[k - 1], upper, shared, *(carried if k == 1 else ()))
        if k > 1:
            upper = upper.select("tree", F.col("place").alias("block"), "path", *shared)
    if len(levels) > 1:
        return upper
    return levels[0].join(above, "tree").select("tree", "place", "hash", *carried, "path", *shared)


def _extended(nodes: DataFrame, upper: DataFrame, shared: list[str], *carried: str) -> DataFrame:
    one = _subtrees(nodes, *carried).join(upper, ["tree", "block"])
    each = F.transform("own", lambda node, i: F.struct(node.alias("node"), F.concat(_siblings(i), F.col("path")).alias("path")))
    rows = one.select("tree", *shared, F.explode(each).alias("one"))
    return rows.select("tree", "one.node.place", "one.node.hash", *(F.col(f"one.node.{c}") for c in carried), "one.path", *shared)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda below, step: hashed(step["before"], below, step["after"]))


def proof(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.concat_ws("", F.transform(path, lambda step: F.concat(step["before"], step["after"])))


def manifest(rows: DataFrame, tree: Column, key: Column, leaf: Column, **carried: Column) -> DataFrame:
    """(key, leaf, carried columns, subroot, root, path) of every row.

    `tree` is text (null: a tree of its own, the first); trees are ordered bytewise.
    """
    named = F.coalesce(F.concat(F.lit(":"), tree), F.lit("-"))  # keeps the order, null first
    leaves = stored(rows.select(named.alias("tree"), key.alias("key"), leaf.alias("hash"), *(c.alias(n) for n, c in carried.items())))
    levels = built(_placed(leaves, "key", "hash"))
    subroots = levels[-1].select("tree", "hash").withColumnsRenamed({"tree": "name", "hash": "subroot"})
    upper = built(_placed(subroots.select(F.lit("").alias("tree"), F.col("subroot").alias("hash"), "name"), "name"))
    root = upper[-1].select("tree", F.col("hash").alias("root"), F.array().cast(_PATH).alias("path"))
    above = stored(paths(upper, root, "name").select(F.col("name").alias("tree"), F.col("hash").alias("subroot"), "root", "path"))
    found = paths(levels, above, "key", *carried)
    return found.select("key", F.col("hash").alias("leaf"), *carried, "subroot", "root", "path")


def manifest_report(docs: DataFrame) -> DataFrame:
    """Digest for every document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Documents whose unsigned CRC-32 of the decimal doc_id is even are verified with the line feeds of their text deleted.
    """
    said = lambda text: hashed(*(field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    broken = F.when(even & F.contains("text", F.lit("\n")), said(F.replace("text", F.lit("\n"), F.lit(""))))
    found = manifest(docs, F.col("source"), F.col("doc_id"), said(F.col("text")), broken=broken)
    rooted = found.withColumn("folded_root", folded(F.coalesce("broken", "leaf"), F.col("path")))
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return rooted.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), "folded_root", verified)
