"""SimHash near-duplicates with bit-sliced comparison.

A document's fingerprint has the majority bit of the hashes of its three-word shingles. Two fingerprints within 3 bits
agree on one of 4 blocks of 16 bits and, beyond it, on one of 4 of the rest; each of these 16 choices is a table, and only
fingerprints that share a table's key are compared. There the 64 bit planes of a block are stored vertically, one machine
word for 64 fingerprints: a query bit flips a plane, carry-save adders count the differing bits of all of them at once,
and a query is abandoned as soon as all its counters have passed the radius. A task reports a spanning forest of its
links, never all pairs; components over these forests give the groups.

Equal fingerprints are one node, however many documents carry them. A key shared by more than `TILE` fingerprints is dealt
into tiles and every pair of tiles is a group of its own, so no task holds a hot key and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from agencylens.llm.graph import components
from agencylens.llm.shared import cut, packed

SHINGLE, SEED, BITS, RADIUS = 3, 42, 64, 3
#: Fingerprints of a key that one task compares, rows of a pack of small keys, shingles whose bits are counted at a time.
TILE, PACK, CHUNK = 4096, 256, 1 << 17
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes | None) -> np.ndarray:
    """XXH64 of every three-word shingle of a text in UTF-8, A-Z lower-cased; of all its words, if they are fewer."""
    words = (text or b"").lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < SHINGLE:
        return np.array([digest(join(words), SEED)], np.uint64)
    runs = zip(*(words[k:] for k in range(SHINGLE)))
    return np.fromiter((digest(join(run), SEED) for run in runs), np.uint64, len(words) - SHINGLE + 1)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes; 0 of none."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = np.ascontiguousarray(hashes[at : at + CHUNK]).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Struct `doc` of the kept columns and `fp`, the fingerprint as a signed long; a text that is null or has no word has 0."""
    rows = packed(docs, keep, text=F.col("text"))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (v.as_buffer().to_pybytes() if v.is_valid else None for v in batch.column("text"))
            fps = pa.array([majority(shingle_hashes(t)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), fps], ["doc", "fp"])

    return rows.mapInArrow(marked, f"doc {rows.schema['doc'].dataType.simpleString()}, fp long")


def planes(values: np.ndarray) -> np.ndarray:
    """(64, words): bit b of value i is bit i % 64 of word i // 64 of row b; places beyond the values repeat the last one."""
    padded = np.append(values, np.full(-len(values) % 64, values[-1]))
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(queries: np.ndarray, block: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """(queries, values): which values of the block differ from a query in at most `radius` bits (0 to 3)."""
    upright = planes(block)
    near = np.zeros((len(queries), upright.shape[1]), np.uint64)
    live = np.arange(len(queries))
    masks = ((queries[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)) * ALL
    ones, twos, over = (np.zeros_like(near) for _ in range(3))

    def add(total: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = total ^ a
        return half ^ b, (total & a) | (half & b)

    for p in range(0, BITS, 4):
        d = [upright[p + k][None, :] ^ masks[:, p + k, None] for k in range(4)]
        ones, first = add(ones, d[0], d[1])
        ones, second = add(ones, d[2], d[3])
        twos, fours = add(twos, first, second)
        over |= fours
        if p % 16 == 12:
            hope = (over != ALL).any(axis=1)
            if not hope.all():
                live, masks, ones, twos, over = live[hope], masks[hope], ones[hope], twos[hope], over[hope]
                if not len(live):
                    break
    above = (over, over | (ones & twos), over | twos, over | twos | ones)[RADIUS - radius]
    near[live] = ~above
    return np.unpackbits(np.ascontiguousarray(near).astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, : len(block)].astype(bool)


def forest(values: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each value the position of its tree's root in a spanning forest of the links among them (the least position)."""
    label = np.arange(len(values))
    for at in range(0, len(values), PACK):
        rows = np.arange(at, min(at + PACK, len(values)))
        linked = within(values[rows], values[at:], radius)
        while True:
            i, j = np.nonzero(linked & (label[rows][:, None] != label[None, at:]))
            if not len(i):
                break
            a, b = label[rows[i]], label[at + j]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label = label[label]
    return label


def _keys(fp: Column, radius: int) -> Column:
    """One struct (table, key) for each choice of a block and, of the rest, of a block that must agree."""

    def split(bits: list[int]) -> list[list[int]]:
        edges = [len(bits) * k // (radius + 1) for k in range(radius + 2)]
        return [bits[a:b] for a, b in zip(edges, edges[1:])]

    every = list(range(BITS))
    chosen = [first + second for first in split(every) for second in split([b for b in every if b not in first])]
    signed = lambda bits: (m := sum(1 << b for b in bits)) - (1 << BITS if m >> 63 else 0)
    return F.array(*(F.struct(F.lit(t).alias("table"), fp.bitwiseAND(F.lit(signed(bits)).cast("long")).alias("key")) for t, bits in enumerate(chosen)))


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect all fingerprints `fp` within the radius: a spanning forest of every group."""
    rows = distinct.select("fp", F.inline(_keys(F.col("fp"), radius)))
    heavy = rows.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile)
    heavy = heavy.select("table", "key", F.ceil(F.col("n") / F.lit(tile)).alias("tiles"))
    dealt = rows.join(heavy, ["table", "key"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1).cast("long")))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    group = F.struct("table", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    spread = dealt.select(F.xxhash64(group).alias("group"), "fp")
    # groups whose hashes meet are compared together, which only adds true links
    sorted_rows = spread.repartition("group").sortWithinPartitions("group")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _packs(batches):
            root = forest(values, radius)
            own = np.flatnonzero(root != np.arange(len(values)))
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(values[own].view(np.int64)), pa.array(values[root[own]].view(np.int64))], ["u", "v"])

    return sorted_rows.mapInArrow(compared, "u long, v long")


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Fingerprints of whole groups: groups of more than one, up to PACK rows together, larger ones alone."""
    group, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        group = np.append(group, batch.column("group").to_numpy(zero_copy_only=False))
        fp = np.append(fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
        whole = int(np.searchsorted(group, group[-1])) if len(group) else 0
        yield from _pack(group[:whole], fp[:whole])
        group, fp = group[whole:], fp[whole:]
    yield from _pack(group, fp)


def _pack(group: np.ndarray, fp: np.ndarray) -> Iterator[np.ndarray]:
    if not len(group):
        return
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(first, len(group)))
    for k in np.flatnonzero(size > PACK):
        yield fp[first[k] : first[k] + size[k]]
    small = np.repeat((size > 1) & (size <= PACK), size)
    rest, ends = fp[small], np.cumsum(size[(size > 1) & (size <= PACK)])
    start = 0
    while start < len(rest):
        stop = int(ends[np.searchsorted(ends, start + PACK, side="right") - 1])
        yield np.unique(rest[start:stop])
        start = stop


def groups(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) of every distinct fingerprint of `marked`: the least fingerprint reachable."""
    distinct = cut(marked.select("fp").distinct())
    rooted = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    return distinct.join(rooted, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, fingerprint, component_id, for every document. Ids that are null don't name a component unless all of its are."""
    marked = cut(fingerprints(docs, keep=["doc_id"]).select("doc.doc_id", "fp"))
    return _named(marked).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _named(marked: DataFrame) -> DataFrame:
    least = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(groups(marked), "fp"))
    named = least.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return marked.join(least.drop("doc_id").join(named, "root"), "fp")

