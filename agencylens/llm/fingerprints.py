"""Document fingerprints by consistent weighted sampling: their collision rate is the generalised Jaccard similarity.

Terms are shingles of five words (A-Z lower-cased; all words, if they are fewer), weighted by how often they occur. For each
of 128 samples every term draws r and c of Gamma(2, 1) and b of (0, 1) from its own hash; with weight S it stands at
t = floor(ln S / r + b) with a = c / exp(r (t - b + 1)), and the term of least a is the sample, known by 16 bits of (term, t).
Two texts share a sample with the probability sum(min(S, S')) / sum(max(S, S')) (and 2^-16 by chance).

The draws start from the sums and shares of exponentials: with A, B and E of Exp(1), let c = A + B, r = E - ln(A / c) and
b = E / r. These have just the distributions above, and for weight 1, where t = 0, they give a = A. So terms of weight 1,
nearly all, need one hash and a minimum, and A grows with the hash; only repeated terms need logarithms.

Texts that are null, empty or without a word have no terms: their fingerprint is all zero, alike to each other and to no
other. A text of any length is one value of its row; its terms are handled `CHUNK` at a time. Equal texts have equal
fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from agencylens.llm.shared import packed, stored
from agencylens.llm.shingles import FIRST, SECOND, mixed, run_hashes

SHINGLE, SAMPLES = 5, 128
#: Terms whose samples are drawn at a time.
CHUNK = 256
#: Multipliers of a published 32-bit mixing function, and the step of a 64-bit one.
SMALL, OTHER, STEP = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35), np.uint64(0x9E3779B97F4A7C15)


_OWN = (mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * STEP) >> np.uint64(32)).astype(np.uint32)


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles and their weights."""
    return np.unique(run_hashes(text.encode(), SHINGLE), return_counts=True)


class Sampler:
    """Draws the samples of one text after the other in the same memory."""

    def __init__(self) -> None:
        self._work = np.empty((2, CHUNK, SAMPLES), np.uint32)

    def _drawn(self, own: np.ndarray) -> np.ndarray:
        """(terms, samples): each term's hash for each sample; valid until the next call."""
        x, y = self._work[:, : len(own)]
        np.bitwise_xor((own >> np.uint64(32)).astype(np.uint32)[:, None], _OWN[None, :], out=x)
        np.multiply(x, SMALL, out=x)
        np.right_shift(x, 15, out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, OTHER, out=x)
        return x

    def sampled(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The fingerprint: 16 bits of every sample, none of them zero; all are zero without terms."""
        if not len(hashes):
            return np.zeros(SAMPLES, "<u2")
        least = np.full(SAMPLES, np.inf)
        name = np.zeros(SAMPLES, np.uint64)
        once = hashes[weights == 1]
        if len(once):
            first = np.full(SAMPLES, np.iinfo(np.uint32).max, np.uint32)
            for at in range(0, len(once), CHUNK):
                np.minimum(first, self._drawn(once[at : at + CHUNK]).min(axis=0), out=first)
            name = first.astype(np.uint64)
            least = np.log(_exponential(name))  # a = A
        more = np.flatnonzero(weights != 1)
        for at in range(0, len(more), CHUNK):
            some = more[at : at + CHUNK]
            drawn = self._drawn(hashes[some]).astype(np.uint64)
            a, b, e = _exponential(drawn), _exponential(mixed(drawn + FIRST) >> np.uint64(32)), _exponential(mixed(drawn + SECOND) >> np.uint64(32))
            c = a + b
            r = e - np.log(a / c)
            share = e / r
            t = np.floor(np.log(weights[some].astype(float))[:, None] / r + share)
            found = np.log(c) - r * (t - share + 1)
            best = found.argmin(axis=0)[None, :]
            found, drawn, t = (np.take_along_axis(x, best, axis=0)[0] for x in (found, drawn, t))
            wins = found < least
            least = np.where(wins, found, least)
            name = np.where(wins, drawn + t.astype(np.int64).astype(np.uint64) * STEP, name)
        return np.maximum(mixed(name) & np.uint64(0xFFFF), np.uint64(1)).astype("<u2")

    def fingerprint(self, text: str | None) -> np.ndarray:
        return self.sampled(*terms(text or ""))


def _exponential(hashes: np.ndarray) -> np.ndarray:
    """Exp(1) of hashes below 2^32, growing with them."""
    return -np.log1p(-(hashes.astype(float) + 0.5) * 2.0**-32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the samples that collide."""
    return float((a == b).mean())


def fingerprints(docs: DataFrame) -> DataFrame:
    """Struct `doc` of every row and `fingerprint`, 2 bytes for each sample."""
    rows = packed(docs, text=F.col("text"))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            found = pa.array([sampler.fingerprint(t.as_py()).tobytes() for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), found], ["doc", "fingerprint"])

    return rows.mapInArrow(marked, f"doc {rows.schema['doc'].dataType.simpleString()}, fingerprint binary")


def edited(text: str, following: str) -> str:
    """The text, its last half replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(sampler: Sampler, doc_id: object, text: str, own: np.ndarray, following: str, theirs: np.ndarray) -> dict:
    changed = edited(text, following)
    after = sampler.fingerprint(changed)
    return {
        "doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed.encode()).digest(), "fingerprint": own.tobytes(), "edited_fingerprint": after.tobytes(),
        "near_edited": likeness(own, after), "near_next": likeness(own, theirs),
    }


def compared(docs: DataFrame) -> DataFrame:
    """Every document beside its edited text and the next document by doc_id (null first; ties by hash, then text): doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. After the last document comes the first.

    Texts are shuffled once, by ranges of (doc_id, hash), and compared in order within a partition. A partition's last
    document meets the next partition's first one afterwards: two documents a partition, found by its number.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").select("doc_id", "text")
    kind = ordered.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sampler = TaskContext.get().partitionId(), Sampler()
        last = None
        for batch in batches:
            made = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                own = sampler.fingerprint(text)
                if last is None:
                    made.append({"edge": 1, "part": part, "doc_id": doc_id, "text": text, "fingerprint": own.tobytes()})
                else:
                    made.append({"edge": 0} | _compared(sampler, *last, text, own))
                last = doc_id, text, own
            yield pa.RecordBatch.from_pylist(made, schema)
        if last is not None:
            yield pa.RecordBatch.from_pylist([{"edge": 2, "part": part, "doc_id": last[0], "text": last[1], "fingerprint": last[2].tobytes()}], schema)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, number = Sampler(), lambda x: np.frombuffer(x, "<u2")
        for batch in batches:
            made = [_compared(sampler, r["doc_id"], r["text"], number(r["fingerprint"]), r["following"], number(r["theirs"])) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(made, pa.schema([f for f in schema if f.name in done]))

    with_edges = f"edge int, part int, text string, {result}"
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], with_edges).schema)
    done = [part.split()[0] for part in result.split(", ")]
    rows = stored(ordered.mapInArrow(beside, with_edges))
    first, last = rows.filter("edge = 1"), rows.filter("edge = 2")
    parts = sorted(r["part"] for r in first.select("part").collect())  # one number for each partition
    turns = docs.sparkSession.createDataFrame([*zip(parts, parts[1:] + parts[:1])], "part int, next int")
    theirs = first.select(F.col("part").alias("next"), F.col("text").alias("following"), F.col("fingerprint").alias("theirs"))
    pairs = last.join(turns, "part").join(theirs, "next").select("doc_id", "text", "fingerprint", "following", "theirs")
    return rows.filter("edge = 0").select(*done).unionByName(pairs.mapInArrow(met, result))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Digest of `compared`, hashes and fingerprints in lowercase hex."""
    text = {c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return compared(docs).withColumns(text)
