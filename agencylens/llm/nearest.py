"""Approximate nearest neighbours by an adaptive dimension scan of inverted lists.

Vectors are put into the list of their nearest centroid (k-means over a bounded sample) and turned by one random rotation,
so that any leading coordinates are a fair sample of a distance. A query probes the nearest lists, `PROBE_SHARE` of all.
Within a list, candidates lie in blocks of columns; after each block of columns a hypothesis test on the partial distance,
scaled up, abandons candidates that are farther than the query's tenth nearest so far. Those that are left get the exact
distance of the original vectors. The first list gives every query its first tenth nearest; all other lists start from it.

Every row is indexed. Lists are split into blocks of rows and their queries into chunks, so that a task holds one block
and one chunk whatever a list's size. Of identical vectors only the `k` + 1 smallest ids can be among a query's nearest,
so no more of them are kept.

Vectors that are null, zero, of another length than most, or hold a null or non-finite component take no part; nor do null
ids. Rows that repeat id and vector are one; other rows of a query's id count as its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from agencylens.llm.shared import cut, shipped

K = 10
#: Bound of the sample behind the centroids, most lists, rounds of k-means, share of lists probed.
SAMPLE_ROWS, MOST_LISTS, ROUNDS, PROBE_SHARE = 1 << 14, 4096, 8, 0.9
#: Rows of a block, queries of a chunk, columns of a column block, and the test's confidence.
BLOCK_ROWS, CHUNK_QUERIES, COLUMNS, CONFIDENCE = 2048, 512, 16, 2.1
SEED = 7

_FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part, each once."""
    component = F.col("embedding")
    finite = F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(component, lambda x: x != 0)
    rows = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & component.isNotNull() & F.coalesce(finite & some, F.lit(False)))
    most = rows.groupBy(F.size("embedding").alias("n_dims")).count().orderBy(F.desc("count"), "n_dims").limit(1).first()
    return rows.filter(F.size("embedding") == (most["n_dims"] if most else 0))


def centroids(sample: np.ndarray, n_lists: int, rounds: int = ROUNDS) -> np.ndarray:
    """k-means from distinct sample rows; a list that loses its rows keeps its centroid."""
    centres = np.unique(sample, axis=0)
    centres = centres[np.random.default_rng(SEED).permutation(len(centres))[:n_lists]].copy()
    for _ in range(rounds):
        own = _nearest(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        counts = np.bincount(own, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n nearest centres of each row, nearest first, ties to the first."""
    away = (centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T
    return np.argsort(away, axis=1, kind="stable")[:, :n] if n > 1 else away.argmin(axis=1)[:, None]


def scan(queries: np.ndarray, ids: np.ndarray, bounds: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, rotation: np.ndarray, k: int = K) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, row ids, distances) of each query's k nearest of a block's rows, its own id excepted; rows beyond a query's bound may be missing."""
    turned, asked = rows @ rotation, queries @ rotation
    n_dims = rows.shape[1]
    edges = [*range(0, n_dims, COLUMNS), n_dims]
    columns = [np.ascontiguousarray(turned[:, a:b]) for a, b in zip(edges, edges[1:])]
    for query, own, turned_query, bound in zip(queries, ids, asked, bounds, strict=True):
        live = np.flatnonzero(row_ids != own)
        partial = np.zeros(len(live))
        for (a, b), block in zip(zip(edges, edges[1:]), columns):
            if not len(live):
                break
            partial += ((block[live] - turned_query[a:b]) ** 2).sum(axis=1)
            if np.isfinite(bound) and b < n_dims:  # farther in truth, but for a small chance?
                stays = partial * (n_dims / b) <= bound**2 * (1 + CONFIDENCE / np.sqrt(b)) ** 2
                live, partial = live[stays], partial[stays]
        if np.isfinite(bound):
            live = live[partial <= bound**2 * (1 + 1e-9) + 1e-30]
        if len(live):
            score = np.sqrt(((rows[live] - query) ** 2).sum(axis=1))
            best = np.lexsort((row_ids[live], score))[:k]
            yield int(own), row_ids[live][best], score[best]


def search(vectors: DataFrame, queries: DataFrame, k: int = K, probe_share: float = PROBE_SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query (vec_id, embedding), nearest first, ties to the smaller vec_id."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toPandas()  # SAMPLE_ROWS vectors at most
    if sample.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = np.stack(sample["embedding"]).astype(np.float64)
    centres = centroids(points, min(MOST_LISTS, max(1, round(rows.count() ** 0.5))))
    n_dims, n_lists = points.shape[1], len(centres)
    probes = max(1, round(probe_share * n_lists))
    rotation = np.linalg.qr(np.random.default_rng(SEED).standard_normal((n_dims, n_dims)))[0]
    shared = shipped(spark, (centres, rotation), "centroids and rotation")

    def listed(n: int):
        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, _ = shared.value
            for batch in batches:
                own = np.stack(batch.column("embedding").to_numpy(zero_copy_only=False)).astype(np.float64) if batch.num_rows else np.zeros((0, n_dims))
                for at in range(0, len(own), 1024):
                    near = _nearest(own[at : at + 1024], centres, n)
                    part = batch.slice(at, 1024)
                    yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("embedding"), pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32()))], ["vec_id", "embedding", "lists"])

        return assign

    element = rows.schema["embedding"].dataType.simpleString()
    schema = f"vec_id long, embedding {element}, lists array<int>"
    alike = Window.partitionBy("embedding").orderBy("vec_id")
    kept = rows.withColumn("place", F.dense_rank().over(alike)).filter(F.col("place") <= k + 1).groupBy("embedding", "vec_id").agg(F.first("place")).select("vec_id", "embedding")
    index = cut(kept.mapInArrow(listed(1), schema).select("vec_id", "embedding", F.col("lists")[0].alias("list")))
    asked = usable(queries).distinct()
    probing = cut(asked.mapInArrow(listed(probes), schema).select(F.col("vec_id").alias("query_id"), "embedding", F.posexplode("lists").alias("turn", "list")))

    def parts(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias(name))

    def scanned(asking: DataFrame) -> DataFrame:
        of = parts(index, BLOCK_ROWS, "blocks").join(parts(asking, CHUNK_QUERIES, "chunks"), "list")  # a row for each list
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        some = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        left = index.join(F.broadcast(of), "list").withColumn("block", some("vec_id", "blocks")).withColumn("chunk", every("chunks"))
        right = asking.join(F.broadcast(of), "list").withColumn("chunk", some("query_id", "chunks")).withColumn("block", every("blocks"))

        def compare(candidates: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            _, rotation = shared.value
            if candidates.empty or own.empty:
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            block = np.stack(candidates["embedding"]).astype(np.float64)
            found = list(scan(np.stack(own["embedding"]).astype(np.float64), own["query_id"].to_numpy(), own["bound"].to_numpy(float), block, candidates["vec_id"].to_numpy(), rotation, k))
            return pd.DataFrame({
                "query_id": np.concatenate([np.full(len(i), q) for q, i, _ in found] or [[]]).astype(np.int64),
                "vec_id": np.concatenate([i for _, i, _ in found] or [[]]).astype(np.int64),
                "score": np.concatenate([s for _, _, s in found] or [[]]).astype(float),
            })

        grouped = left.select("list", "block", "chunk", "vec_id", "embedding").groupBy("list", "block", "chunk")
        return grouped.cogroup(right.select("list", "block", "chunk", "query_id", "embedding", "bound").groupBy("list", "block", "chunk")).applyInPandas(compare, _FOUND)

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    nearest = lambda df: df.withColumn("rank", rank).filter(F.col("rank") <= k)
    first = cut(nearest(scanned(probing.filter(F.col("turn") == 0).withColumn("bound", F.lit(float("inf"))))))
    bounds = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.max("score")).otherwise(F.lit(float("inf"))).alias("known"))
    rest = probing.filter(F.col("turn") > 0).join(bounds, "query_id", "left").withColumn("bound", F.coalesce("known", F.lit(float("inf"))))
    both = first.drop("rank").unionByName(scanned(rest))
    return nearest(both).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_report(vectors: DataFrame) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 100."""
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
