import numpy as np
import pytest

from agencylens.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, list int"


def exact(rows, query, k=10):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], np.float32).astype(float)
    own = points[ids == query][0]
    away = np.sqrt(((points - own) ** 2).sum(axis=1))
    others = ids != query
    order = np.lexsort((ids[others], away[others]))[:k]
    return [(int(ids[others][i]), float(away[others][i])) for i in order]


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2) for i, v in rows], SCHEMA)


def test_recall_and_scores(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    got = {}
    for r in nearest.search_report(vectors).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i, _ in rows if i % 100 == 0}
    hits = total = 0
    for query, found in got.items():
        best = exact(rows, query)
        hits += len({i for i, _ in best} & {i for _, i, _ in found})
        total += len(best)
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        assert [(s, i) for _, i, s in sorted(found)] == sorted((s, i) for _, i, s in found)
    assert hits >= 0.9 * total


def test_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(20)) for i in range(1, 400)]
    same = rng.standard_normal(20)
    rows += [(1000 + i, same) for i in range(60)] + [(0, same), (100_000, rng.standard_normal(20))]
    odd = [(500, None), (600, [0.0] * 20), (700, [float("nan")] + [1.0] * 19), (800, [None] + [1.0] * 19), (900, [1.0] * 3), (None, list(same)), (1001, list(same))]
    got = {}
    for r in nearest.search(frame(spark, rows + odd), frame(spark, [x for x in rows + odd if x[0] is not None and x[0] % 100 == 0]), probe_share=1.0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 100, 200, 300, 1000, 100_000}
    for query, found in got.items():
        assert [(i, pytest.approx(s, abs=1e-12)) for _, i, s in sorted(found)] == exact(rows, query), query
    assert [i for _, i, _ in sorted(got[1000])] == [0, *range(1001, 1010)]


def test_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 16)
    monkeypatch.setattr(nearest, "CHUNK_QUERIES", 2)
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8)) for i in range(300)]
    asked = frame(spark, rows[::20])
    got = nearest.search(frame(spark, rows), asked, probe_share=1.0).collect()
    hits = sum(r["vec_id"] in {i for i, _ in exact(rows, r["query_id"])} for r in got)
    assert len(got) == 150 and hits >= 0.9 * len(got)


def test_few_rows(spark):
    few = frame(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])])
    assert [tuple(r) for r in nearest.search_report(few).orderBy("rank").collect()] == [(0, 1, 2, 1.0), (0, 2, 1, pytest.approx(2**0.5))]
    assert nearest.search_report(frame(spark, [(0, [1.0, 0.0])])).collect() == []
    assert nearest.search_report(few.limit(0)).collect() == []
    assert nearest.search_report(frame(spark, [(0, None)])).collect() == []
