"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes of its words, its pairs of neighbours and its pairs with one word between. Every
coordinate has a learning rate of its own and is zero until its gradients outweigh L1, so what is left of 2^20 coordinates
is a small list of weights, which is broadcast. Training sees at most `TRAIN_ROWS` labelled documents, those with the
smallest hash of their id, in one task and in that order, and of them as many as have `TRAIN_COORDINATES` features together;
scoring streams over all documents without a shuffle.

Rows that share a doc_id count once in training, with the least of their feature lists, and are scored row by row. Very long
texts are scored whole; their features are distinct, so at most 2^20. A null or empty text has no feature and scores the
bias. Original columns travel in one struct, so no name clashes. Equal hashes of ids are ordered by the id.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from agencylens.llm.shared import held_out, packed, shipped

#: The bound of the training sample, in rows.
TRAIN_ROWS = 8192
#: The bound of the training sample's features, 4 bytes each in the training task.
TRAIN_COORDINATES = 1 << 26
EPOCHS = 5
SPACE = 1 << 20
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 1.0
THRESHOLD = 0.3
#: A-Z to a-z; letters, digits and bytes beyond ASCII stay; all else is a space.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Odd multipliers that tell the kinds of features and the places in a pair apart.
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def features(text: bytes | None) -> np.ndarray:
    """Distinct coordinates of a text, sorted."""
    words = (text or b"").translate(_BYTES).split()
    ids = np.fromiter(map(crc32, words), np.uint64, len(words))
    one, first, second, left, right = (np.uint64(m) for m in _MIX)
    parts = [ids * one]
    if len(ids) > 1:
        parts.append(ids[:-1] * first + ids[1:] * second)
    if len(ids) > 2:
        parts.append(ids[:-2] * left + ids[2:] * right)
    return np.unique((np.concatenate(parts) ^ (np.concatenate(parts) >> np.uint64(29))) >> np.uint64(4) & np.uint64(SPACE - 1)).astype(np.int64)


def train(examples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """Coordinates, their weights and the bias, by FTRL-proximal over the examples in the given order."""
    z, n = np.zeros(SPACE), np.zeros(SPACE)
    bias, bias_n = 0.0, 0.0
    for _ in range(epochs):
        for own, label in examples:
            zi, ni = z[own], n[own]
            w = np.where(np.abs(zi) > L1, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2), 0.0)
            g = 1.0 / (1.0 + np.exp(-np.clip(bias + w.sum(), -30, 30))) - label
            z[own] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[own] = ni + g * g
            bias_n += g * g
            bias -= ALPHA * g / (BETA + np.sqrt(bias_n))
    live = np.flatnonzero(np.abs(z) > L1)
    return live, (np.sign(z[live]) * L1 - z[live]) / ((BETA + np.sqrt(n[live])) / ALPHA + L2), bias


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, coordinates_in_all: int = TRAIN_COORDINATES) -> tuple[np.ndarray, np.ndarray, float]:
    """The model, from labelled documents that are not held out.

    Null labels are left out, of several for one document the largest counts. Without any label the bias is that of a
    score near 0. The sample's ids, at most `rows`, are what is broadcast; texts go to the training task alone.
    """
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("id"), "label")
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id"))  # at most `rows` ids

    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [features(v.as_buffer().to_pybytes() if v.is_valid else None).astype(np.int32).tobytes() for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(own, pa.binary())], ["id", "label", "own"])

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, size = [], 0
        for batch in batches:
            for own, label in zip(batch.column("own"), batch.column("label"), strict=True):
                size += len(own.as_buffer()) // 4
                if size <= coordinates_in_all:
                    examples.append((np.frombuffer(own.as_buffer(), np.int32).copy(), label.as_py()))
        where, weight, bias = train(examples) if examples else (np.zeros(0, np.int64), np.zeros(0), -30.0)
        arrays = [pa.array(np.append(where, -1)), pa.array(np.append(weight, bias))]
        yield pa.RecordBatch.from_arrays(arrays, ["place", "weight"])

    light = chosen.mapInArrow(coordinates, f"id {sample.schema['id'].dataType.simpleString()}, label int, own binary")
    light = light.groupBy("id", "label").agg(F.min("own").alias("own"))  # an id on many rows is one example
    ordered = light.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id", "own")
    model = ordered.mapInArrow(trained, "place long, weight double").toPandas()  # at most SPACE weights
    if model.empty:
        return np.zeros(0, np.int64), np.zeros(0), -30.0
    bias = model["place"] == -1
    return model["place"][~bias].to_numpy(), model["weight"][~bias].to_numpy(), float(model["weight"][bias].iloc[0])


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], keep: list[str] | None = None) -> DataFrame:
    """Struct `doc` of the kept columns and `score`, 0 to 1, of every whole text; an empty or null text has the bias alone."""
    rows = packed(docs, keep, text=F.col("text"))
    shared = shipped(docs.sparkSession, model, "the weights")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, weight, bias = shared.value
        dense = np.zeros(SPACE)
        dense[where] = weight
        for batch in batches:
            sums = [dense[features(v.as_buffer().to_pybytes() if v.is_valid else None)].sum() for v in batch.column("text")]
            scores = 1.0 / (1.0 + np.exp(-np.clip(np.array(sums, float) + bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(scores, pa.float64())], ["doc", "score"])

    return rows.mapInArrow(score, f"doc {rows.schema['doc'].dataType.simpleString()}, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Digest: doc_id, held_out, score, predicted."""
    rated = scored(docs, fit(docs, labels), keep=["doc_id"])
    doc_id = F.col("doc.doc_id")
    return rated.select(doc_id, held_out(doc_id).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below the threshold, unchanged."""
    return scored(docs, fit(docs, labels)).filter(F.col("score") < THRESHOLD).select("doc.*")
