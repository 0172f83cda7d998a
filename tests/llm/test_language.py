import os
import zlib
from itertools import combinations

import numpy as np
import pytest

from agencylens.llm import language
from agencylens.llm.language import Lattice

pytestmark = pytest.mark.skipif(not os.path.exists(language.VOCABULARY), reason="the vocabulary is not there")

TOY = sorted(["▁", "a", "b", "ab", "ba", "▁a", "aba"])


def every_segmentation(lattice, word, table):
    """Sum over all cuts, piece by piece."""
    total = np.zeros(table.shape[1])
    for n in range(len(word)):
        for cuts in combinations(range(1, len(word)), n):
            ends = [0, *cuts, len(word)]
            product = np.ones(table.shape[1])
            for a, b in zip(ends, ends[1:]):
                piece = lattice.number.get(word[a:b], lattice.unknown if b - a == 1 else lattice.none)
                product *= table[piece]
            total += product
    return total


def table_of(lattice, seed=0):
    p = np.random.default_rng(seed).dirichlet(np.ones(len(lattice.number)), 2).T
    return np.vstack([p, [[language.UNKNOWN] * 2], [[0.0] * 2]])


def test_forward_sums_all_segmentations():
    lattice = Lattice(TOY)
    table = table_of(lattice)
    words = ["▁abab", "▁b", "▁aaba", "▁abcab", "▁", "▁zz"]
    got = lattice.log_probability(words, table)
    assert np.allclose(got, np.log([every_segmentation(lattice, w, table) for w in words]))
    assert np.isfinite(lattice.log_probability(["▁" + "ab" * 5000], table)).all()


def test_expected_counts():
    lattice = Lattice(TOY)
    table = table_of(lattice)[:, :1]
    words, counts = ["▁aba", "▁ab"], np.array([2.0, 3.0])
    got = lattice.expected(words, counts, table)
    expected = np.zeros(len(table))
    for word, n in zip(words, counts):
        whole = every_segmentation(lattice, word, table)[0]
        for size in range(len(word)):
            for cuts in combinations(range(1, len(word)), size):
                ends = [0, *cuts, len(word)]
                parts = [lattice.number.get(word[a:b], lattice.none) for a, b in zip(ends, ends[1:])]
                for p in parts:
                    expected[p] += n * np.prod([table[q, 0] for q in parts]) / whole
    assert np.allclose(got, expected)


def test_learning_raises_the_likelihood():
    lattice, words, counts = Lattice(TOY), ["▁abab", "▁ab", "▁aaba"], np.array([5.0, 9.0, 1.0])
    scores = [counts @ lattice.log_probability(words, language.learned(lattice, words, counts, rounds=r)[:, None])[:, 0] for r in (0, 1, 4)]
    assert scores[0] < scores[1] < scores[2]


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = docs.select("doc_id", "lang").join(language.language_report(docs), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == docs.count() and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_edges(spark, documents):
    rows = [(i, ("der die und nicht ", "the of and that ")[i % 2] * (1 + i % 4), ("de", "en")[i % 2], ("en", "de")[i % 2]) for i in range(60)]
    rows += [(100, None, "de"), (101, "", None), (102, "12 34 ²", "en"), (103, "THE AND", None), (104, "die und", None), (105, "und " * 60_000, None), (None, "that", "de"), (103, "THE AND", None), (106, "ж", None)]
    got = language.language_report(documents(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by_id[100] == by_id[101] == by_id[102] == ("und", 0.0)
    assert by_id[103][0] == "en" and by_id[104][0] == "de" and by_id[105][0] == "de" and by_id[None][0] == "en"
    assert by_id[106][0] in ("de", "en") and by_id[106][1] < 0.6  # an unknown letter tells little


def test_nothing_to_learn(documents):
    docs = documents([(1, "some text", None), (2, None, None)])
    assert {tuple(r)[2:] for r in language.language_report(docs).collect()} == {("und", 0.0)}
    assert language.language_report(docs.limit(0)).collect() == []


def test_groups_of_languages_give_what_all_at_once_give(documents):
    words = ("der die und ", "the of and ", "le la et ", "il lo e ", "el los y ")
    docs = documents([(i, words[i % 5] * (1 + i % 3) + words[(i + 1) % 5], f"l{i % 5}") for i in range(80)] + [(200, None, None), (201, "12", None)])
    whole = {r["doc"]["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identified(docs).collect()}
    for group in (1, 2):
        parts = language.identified(docs, table_bytes=group * 8 * (len(language.pieces()) + 2)).collect()
        assert len(parts) == len(whole) == 82
        for r in parts:
            name, score = whole[r["doc"]["doc_id"]]
            assert r["lang_pred"] == name and abs(r["score"] - score) < 1e-9


def test_an_id_on_many_rows_is_learned_once(documents):
    rows = [(i, ("der die und ", "the of and ")[i % 2], ("de", "en")[i % 2]) for i in range(40)]
    chosen = next(r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2)
    known = language.pieces()
    fitted = lambda r: {x["language"]: x["table"] for x in language.fit(documents(r), known).collect()}
    assert fitted(rows) == fitted(rows + [chosen] * 2000)
    assert language.sampled(documents(rows + [chosen] * 2000)).count() == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(40))
