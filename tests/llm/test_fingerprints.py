import hashlib

import numpy as np
import pytest

from agencylens.llm import fingerprints as fp
from agencylens.llm.shared import table


def weights(text):
    return dict(zip(*(x.tolist() for x in fp.terms(text))))


def jaccard(a, b):
    a, b = weights(a), weights(b)
    every = a.keys() | b.keys()
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in every) / sum(max(a.get(k, 0), b.get(k, 0)) for k in every) if every else 1.0


def brute(rows):
    """Every document against the next by (doc_id, text), the last against the first."""
    sampler = fp.Sampler()
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, after = sampler.fingerprint(text), sampler.fingerprint(changed)
        yield doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(), after.tobytes().hex(), (own == after).mean(), (own == sampler.fingerprint(following)).mean()


def report(docs):
    found = fp.fingerprint_report(docs)
    assert found.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_equals_pairs_in_order(spark, small):
    docs = table(spark, small, "documents")
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert report(docs) == sorted(brute(rows), key=str)


def test_many_partitions_and_one(spark, small):
    docs = table(spark, small, "documents").limit(40)
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = report(docs)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread == report(docs) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("rows", [[], [(1, "a b c d e f")], [(1, None)], [(1, "x"), (1, "x"), (1, "x")]])
def test_few_rows(documents, rows):
    assert report(documents(rows)) == sorted(brute([(i, t or "") for i, t in rows]), key=str)


def test_nulls_empty_long_and_repeated(documents):
    rows = [(None, "null first"), (1, ""), (2, None), (3, " \n "), (4, "é" * 5), (5, "a"), (6, "Is and " * 200_000), (7, "is AND " * 200_000), (9, "Z z \U0001f600 z z z z")]
    assert report(documents(rows)) == sorted(brute([(i, t or "") for i, t in rows]), key=str)
    alike = {r[0]: r for r in report(documents(rows))}
    assert alike[1][6] == alike[2][6] == 1.0 and alike[3][6] == 0.0  # no words; then words
    assert alike[6][6] == 1.0  # A-Z lower-cased
    assert set(alike[1][3]) == {"0"}


def test_ties_of_an_id_are_all_there(documents):
    assert len(report(documents([(1, f"text {k % 3}") for k in range(30)]))) == 30


@pytest.mark.parametrize(("a", "b"), [((1, 1, 1, 1), (1, 1, 1, 0)), ((3, 1, 2, 0), (1, 1, 5, 2)), ((1, 2, 0, 7), (2, 1, 0, 7)), ((40, 3, 1, 1), (1, 3, 1, 1))])
def test_collisions_are_the_generalised_jaccard_similarity(a, b):
    rng, sampler = np.random.default_rng(1), fp.Sampler()
    a, b = np.array(a), np.array(b)
    rates = []
    for _ in range(300):
        terms = rng.integers(0, 2**63, 4).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        rates.append(fp.likeness(sampler.sampled(terms[a > 0], a[a > 0]), sampler.sampled(terms[b > 0], b[b > 0])))
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(np.mean(rates) - truth) < 5 * np.sqrt(truth * (1 - truth) / (300 * fp.SAMPLES)) + 1e-3
    assert np.std(rates) < 1.3 * np.sqrt(truth * (1 - truth) / fp.SAMPLES)  # samples are independent


def test_likeness_follows_the_texts(spark, small):
    rows = sorted((r["doc_id"], r["text"] or "") for r in table(spark, small, "documents").collect())
    off = []
    for (_, text), (_, following), found in zip(rows, rows[1:] + rows[:1], brute(rows)):
        off += [found[5] - jaccard(text, fp.edited(text, following)), found[6] - jaccard(text, following)]
    assert abs(np.mean(off)) < 0.01 and np.abs(off).max() < 0.25


def test_fingerprints_keep_all_columns(documents):
    found = fp.fingerprints(documents([(1, "a b"), (2, "a b"), (3, None)])).collect()
    by = {r["doc"]["doc_id"]: bytes(r["fingerprint"]) for r in found}
    assert by[1] == by[2] != by[3] and len(by[3]) == 2 * fp.SAMPLES and found[0]["doc"]["size"] == 1
