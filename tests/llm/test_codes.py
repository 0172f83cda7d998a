import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from agencylens.llm import codes
from agencylens.llm.shared import table

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows):
    """Full scans by all pairs; rows in the order of id (null last), then components."""
    rows = [r for r in rows if r["embedding"] is not None and all(x is not None and np.isfinite(x) for x in r["embedding"])]
    rows = sorted(rows, key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["embedding"]))
    parts = np.floor(np.array([r["embedding"] for r in rows], float) * 256).astype(np.int64).reshape(len(rows), 16, -1)
    books = parts[:64].copy()

    def scan():
        away = ((parts[:, None] - books[None]) ** 2).sum(axis=-1)
        return away.argmin(axis=1), away.min(axis=1)

    for _ in range(2):
        own, _ = scan()
        for p in range(16):
            for e in range(len(books)):
                if (own[:, p] == e).any():
                    books[e, p] = parts[own[:, p] == e, p].sum(axis=0) // (own[:, p] == e).sum()
    own, away = scan()
    errors = away.sum(axis=1)
    labels = {}
    for r, e in zip(rows, errors):
        labels[r["label"]] = labels.get(r["label"], 0) + int(e)
    digest = codes.codebooks_digest(books.swapaxes(0, 1))
    return [(r["vec_id"], "".join(f"{c:02x}" for c in o), int(e), labels[r["label"]], digest) for r, o, e in zip(rows, own, errors)]


def equal(vectors):
    report = codes.coding_report(vectors)
    assert report.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, report.collect()), key=str) == sorted(brute(vectors.collect()), key=str)


def test_equals_full_scans(spark, small):
    equal(table(spark, small, "embeddings"))


def test_ties_repeats_nulls_and_clashing_names(spark):
    rng = np.random.default_rng(3)
    grid = lambda: (rng.integers(-2, 2, 32) / 128).tolist()  # noqa: E731 few values, so distances tie
    rows = [(k % 90, [None, 1, 2][k % 3], grid()) for k in range(200)] + [(None, 1, grid()), (None, 1, [0.0] * 32)]
    rows += [(5, 1, None), (6, 1, [float("nan")] + [0.0] * 31), (7, 1, [None] + [0.0] * 31), (8, 1, [float("-inf")] + [0.0] * 31)]
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS doc", "'x' AS code", "2 AS own", "3 AS distance", "4 AS vector", "5 AS ints")
    equal(vectors)


def test_fewer_rows_than_entries_one_row_and_none(spark):
    rows = [(k, 1, [float(k)] * 16) for k in range(5)]
    equal(spark.createDataFrame(rows, SCHEMA))
    equal(spark.createDataFrame(rows[:1], SCHEMA))
    assert codes.coding_report(spark.createDataFrame([(1, 1, None)], SCHEMA)).collect() == []
    assert codes.coding_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_lengths(spark):
    assert codes.coding_report(spark.createDataFrame([(1, 1, [0.5] * 16), (2, 1, [0.5] * 16), (3, 1, [0.5] * 32)], SCHEMA)).count() == 2
    assert [r["error"] for r in codes.coding_report(spark.createDataFrame([(1, 1, []), (2, 1, [])], SCHEMA)).collect()] == [0, 0]
    with pytest.raises(ValueError, match="too large"):
        codes.coding_report(spark.createDataFrame([(1, 1, [1e30] * 16)], SCHEMA))
    with pytest.raises(ValueError, match="equal parts"):
        codes.coding_report(spark.createDataFrame([(1, 1, [0.5] * 15)], SCHEMA))


def test_more_rounds_never_read_deleted_rows(spark, small):
    held, books = codes.coded(table(spark, small, "embeddings"), "embedding", F.col("doc.vec_id"), rounds=4, n_entries=8)
    assert books.shape[:2] == (16, 8)
    assert held.count() > 0 and held.agg(F.max(F.array_max("code"))).first()[0] <= 7


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_active_scan_is_a_full_scan(data):
    rng = np.random.default_rng(data.draw(st.integers(0, 2**32)))
    n, m, d = data.draw(st.integers(1, 40)), data.draw(st.integers(1, 9)), data.draw(st.integers(1, 3))
    part, before = rng.integers(-3, 3, (n, d)), rng.integers(-3, 3, (m, d))
    after = np.where(rng.random((m, 1)) < data.draw(st.floats(0, 1)), rng.integers(-3, 3, (m, d)), before)
    code, away = codes.full_scan(part, before)
    moved = (after != before).any(axis=1)
    for got, want in zip(codes.active_scan(part, after, moved, code, away), codes.full_scan(part, after)):
        assert (got == want).all()
