import zlib

import numpy as np

from agencylens.llm import toxicity
from agencylens.llm.toxicity import features


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def corpus(n=1200):
    rng = np.random.default_rng(4)
    names = [f"word{k}" for k in range(400)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        said = list(rng.choice(names, 60))
        if toxic:
            for bad in rng.choice(["vileword", "nastyword", "Foulword"], 3):
                said.insert(int(rng.integers(60)), bad)
        rows.append((i, " ".join(said), "en", "s"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def tables(spark, documents, rows, labels):
    return documents(rows), spark.createDataFrame([(*x, "t") for x in labels], "doc_id long, quality int, toxic int, text string")


def test_held_out_accuracy_and_edges(spark, documents):
    rows, labels = corpus()
    extra = [(5000, None), (5001, ""), (None, "vileword nastyword foulword"), (5002, "word1 " * 80_000), (5003, "calm"), (5003, "calm")]
    docs, known = tables(spark, documents, rows + extra, labels + [(1, 1, None), (None, 1, 1), (6, 1, 0), (77777, 1, 1)])
    got = toxicity.toxicity_report(docs, known).collect()
    assert len(got) == len(rows) + len(extra)
    by_id = {r["doc_id"]: r for r in got}
    tested = [(by_id[i]["predicted"], y) for i, _, y in labels if held(i)]
    assert sum(p == y for p, y in tested) >= 0.98 * len(tested)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == held(r["doc_id"]) for r in got if r["doc_id"] is not None) and by_id[None]["held_out"]
    assert by_id[5000]["score"] == by_id[5001]["score"] and by_id[None]["predicted"] == 1 and by_id[5003]["predicted"] == 0
    again = toxicity.toxicity_report(docs.repartition(5), known).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    clean = toxicity.accepted(docs, known)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {i for i, r in by_id.items() if not r["predicted"]}


def test_sample_is_bounded_and_weights_are_sparse(spark, documents):
    rows, labels = corpus(600)
    where, weight, _ = toxicity.fit(*tables(spark, documents, rows, labels), rows=200)
    assert 0 < len(where) < 2000 and len(where) == len(weight)


def test_without_labels(spark, documents):
    docs, known = tables(spark, documents, [(1, "a b"), (2, None)], [])
    assert [(r["predicted"], r["score"] < 1e-6) for r in toxicity.toxicity_report(docs, known).collect()] == [(0, True)] * 2
    assert toxicity.toxicity_report(docs.limit(0), known).collect() == []


def test_features():
    assert len(features(b"a b c")) == 6 and len(features(b"a")) == 1 and len(features(None)) == len(features(b" .")) == 0
    assert (features(b"A b, C") == features(b"a B c")).all() and len(features("é è".encode())) == 3
    assert len(features(b"a a a a")) == 3


def test_an_id_on_many_rows_is_one_example(spark, documents):
    rows, labels = corpus(600)
    docs, known = tables(spark, documents, rows, labels)
    plain = toxicity.fit(docs, known)
    chosen = next(i for i, _, _ in labels if not held(i))
    copies = tables(spark, documents, rows + [rows[chosen]] * 3000, labels)[0]
    again = toxicity.fit(copies, known)
    assert all((a == b).all() for a, b in zip(plain[:2], again[:2])) and plain[2] == again[2]


def test_features_of_the_sample_are_bounded(spark, documents):
    rows, labels = corpus(200)
    docs, known = tables(spark, documents, rows, labels)
    assert len(toxicity.fit(docs, known, coordinates_in_all=0)[0]) == 0 and toxicity.fit(docs, known, coordinates_in_all=0)[2] == -30.0
