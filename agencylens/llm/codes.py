"""Vector codes by product quantisation, trained by active-entry Lloyd rounds in whole numbers.

Each component x counts as floor(256 x); a vector is cut into 16 equal parts, each with a codebook of its own. The
codebooks start as the parts of the vectors with the smallest ids. A round assigns every part to its nearest entry (ties to
the lower index) and moves each entry to the floored mean of its parts; an entry without parts stays.

Active entries: a part's exact distance is stored beside its code. Where its entry did not move, the other entries that did
not move are still no better, so only the moved ones are compared with the stored distance; a moved one of lower index wins
a tie. Parts whose entry moved compare all entries. The result is that of a full scan, bit by bit.

Vectors, codes and distances are stored between rounds, so a lost executor costs a part of one round; a round's rows go when
the next ones are written. Entries' sums are added up in tasks and by a shuffle; the driver sees the codebooks alone, 16 x
entries x length of a part numbers, whatever the number of rows.

Rows whose vector is null or holds null or non-finite components are dropped, and so are vectors of another length than
most (ties: the shorter). Rows that repeat an id are rows of their own; among the first entries they follow the order of
their components, and null ids come last. Fewer rows than entries make smaller codebooks. A length that 16 does not divide,
and components beyond +-2^30 / 256 / sqrt(length), whose squares a long could not add up, are errors. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from agencylens.llm.shared import discard, packed, shipped, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows whose distances are held at a time.
ROWS = 2048


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """The rows that take part, as struct `doc` and `vector`."""
    rows = packed(vectors, vector=F.col(f"`{column}`").cast("array<double>"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))
    most = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).first()
    return rows.filter(F.size("vector") == (most["n"] if most else -1))


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of (rows, length) components."""
    found = np.floor(vectors * SCALE)
    if len(found) and np.abs(found).max(initial=0) > 2**30 / max(1, found.shape[1]) ** 0.5:
        raise ValueError("components are too large for exact distances in 64 bits")
    return found.astype(np.int64)


def _away(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(rows, entries): squared distances, exact."""
    total = np.zeros((len(part), len(entries)), np.int64)
    for k in range(part.shape[1]):
        total += (part[:, k, None] - entries[None, :, k]) ** 2
    return total


def full_scan(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and distance of each row's nearest entry, ties to the lower index."""
    away = _away(part, entries)
    code = away.argmin(axis=1)
    return code, np.take_along_axis(away, code[:, None], axis=1)[:, 0]


def active_scan(part: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a full scan gives, from the codes and distances of the entries before some `moved`."""
    code, distance = code.copy(), distance.copy()
    again = moved[code]
    active = np.flatnonzero(moved)
    fixed = np.flatnonzero(~again)
    if len(active) and len(fixed):
        best, away = full_scan(part[fixed], entries[active])
        best = active[best]
        wins = (away < distance[fixed]) | ((away == distance[fixed]) & (best < code[fixed]))
        code[fixed[wins]], distance[fixed[wins]] = best[wins], away[wins]
    if again.any():
        code[again], distance[again] = full_scan(part[again], entries)
    return code, distance


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return values.reshape(len(column), len(values) // len(column) if len(column) else 0)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()).cast(kind))


def _parted(ints: np.ndarray) -> np.ndarray:
    """(PARTS, rows, length of a part)."""
    return np.ascontiguousarray(ints.reshape(len(ints), PARTS, ints.shape[1] // PARTS).swapaxes(0, 1))


def _assigned(rows: DataFrame, codebooks: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """Struct `doc`, `ints`, `code` and `distance` by part. Without `moved` rows have vectors and are scanned in full."""
    shared = shipped(rows.sparkSession, (codebooks, moved), "codebooks")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, active = shared.value
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            ints = whole(_matrix(batch.column("vector"), float)) if active is None else _matrix(batch.column("ints"), np.int64)
            parts = _parted(ints)
            if active is None:
                found = [full_scan(parts[p], entries[p]) for p in range(PARTS)]
            else:
                code, away = _matrix(batch.column("code"), np.int64), _matrix(batch.column("distance"), np.int64)
                found = [active_scan(parts[p], entries[p], active[p], code[:, p], away[:, p]) for p in range(PARTS)]
            code, away = (np.stack(x, axis=1) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), _lists(ints, pa.int32()), _lists(code, pa.int16()), _lists(away, pa.int64())], ["doc", "ints", "code", "distance"])

    doc = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(scanned, f"doc {doc}, ints array<int>, code array<smallint>, distance array<bigint>")


def _sums(rows: DataFrame, n_entries: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of parts and sums of components of every entry: (PARTS, entries) and (PARTS, entries, length)."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((PARTS, n_entries), np.int64)
        total = np.zeros((PARTS, n_entries, length), np.int64)
        for batch in batches:
            code, parts = _matrix(batch.column("code"), np.int64), _parted(_matrix(batch.column("ints"), np.int64))
            for p in range(PARTS):
                n[p] += np.bincount(code[:, p], minlength=n_entries)
                np.add.at(total[p], code[:, p], parts[p])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(n[part, entry]), _lists(total[part, entry], pa.int64())], ["part", "entry", "n", "total"])

    spread = rows.select("ints", "code").mapInArrow(added, "part long, entry long, n long, total array<bigint>")
    own = spread.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("total")[k]).alias(f"total_{k}") for k in range(length)))
    n, total = np.zeros((PARTS, n_entries), np.int64), np.zeros((PARTS, n_entries, length), np.int64)
    for row in own.collect():  # PARTS x entries rows at most
        n[row["part"], row["entry"]] = row["n"]
        total[row["part"], row["entry"]] = [row[f"total_{k}"] for k in range(length)]
    return n, total


def coded(vectors: DataFrame, column: str, order: Column, rounds: int = ROUNDS, n_entries: int = ENTRIES) -> tuple[DataFrame, np.ndarray]:
    """Struct `doc` of every usable row with its `code` and `distance` by part, and the final codebooks (PARTS, entries, length).

    The first codebooks are the parts of the `n_entries` rows that come first by `order`, then by their components.
    """
    rows = usable(vectors, column)
    seeds = rows.orderBy(order.asc_nulls_last(), "vector").limit(n_entries).select("vector").collect()  # n_entries rows
    if not seeds:
        return rows.select("doc", F.array().cast("array<smallint>").alias("code"), F.array().cast("array<bigint>").alias("distance")), np.zeros((PARTS, 0, 0), np.int64)
    seeds = np.array([r["vector"] for r in seeds], float)
    if seeds.shape[1] % PARTS:
        raise ValueError(f"vectors of {seeds.shape[1]} components can't be cut into {PARTS} equal parts")
    codebooks = _parted(whole(seeds))
    held = stored(_assigned(rows, codebooks, None))
    for _ in range(rounds):
        n, total = _sums(held, codebooks.shape[1], codebooks.shape[2])
        after = np.where(n[:, :, None] > 0, total // np.maximum(n, 1)[:, :, None], codebooks)
        moved = (after != codebooks).any(axis=2)
        codebooks, before = after, held
        held = stored(_assigned(before, codebooks, moved))
        discard(before)
    return held.select("doc", "code", "distance"), codebooks


def codebooks_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def coding_report(vectors: DataFrame) -> DataFrame:
    """Digest of every usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    held, codebooks = coded(vectors.select("vec_id", "label", "embedding"), "embedding", F.col("doc.vec_id"))
    two = F.transform("code", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0")))
    error = F.aggregate("distance", F.lit(0).cast("long"), lambda a, d: a + d)
    rows = held.select("doc.vec_id", "doc.label", F.concat_ws("", two).alias("code"), error.alias("error"))
    by_label = rows.groupBy(F.col("label").alias("own")).agg(F.sum("error").alias("label_error"))
    named = rows.join(by_label, F.col("label").eqNullSafe(F.col("own")))  # as many rows as labels; the planner sees its size
    return named.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))
