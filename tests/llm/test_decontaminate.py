import hashlib
import re

import numpy as np
from pyspark import cloudpickle

from agencylens.llm import decontaminate, shared

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text, *_ in docs:
        own, hit, ids = words(text), set(), set()
        for item_id, said in items:
            item = words(said)
            size = min(10, len(item))
            windows = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if item else set()
            for i in range(len(own) - size + 1 if size else 0):
                if tuple(own[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    ids.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(own), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
ITEMS = [(1, ITEM), (1, ITEM), (2, "two words"), (10, "single"), (3, None), (4, "..."), (None, "ünï cödé 42"), (5, "the " * 30), (6, "a b a b a b a b a b a b")]
DOCS = [
    (1, "x " + ITEM.upper() + " y"), (2, "alpha beta gamma delta epsilon zeta eta theta iota"), (3, "beta gamma delta, epsilon; zeta-eta theta iota kappa lambda"),
    (4, None), (5, ""), (6, "two words TWO   words single"), (7, "the " * 5000), (8, "ünï cödé 42 and Ünï"), (8, "ünï cödé 42 and Ünï"), (None, "b a b a b a b a b a b"),
    (9, " ".join(ITEM.split()[4:]) + " " + ITEM), (11, "9 " * 70_000 + ITEM), (12, "two\nwords\x00x"), (13, "clean text without any of it"),
]


def run(spark, documents, docs, items, **bounds):
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc string")
    return documents(docs), benchmark


def test_report_equals_brute_force(spark, documents):
    docs, benchmark = run(spark, documents, DOCS, ITEMS)
    got = sorted(map(tuple, decontaminate.decontamination_report(docs, benchmark).collect()), key=str)
    assert got == brute(DOCS, ITEMS)


def test_slices_give_the_same(spark, documents):
    docs, benchmark = run(spark, documents, DOCS, ITEMS)
    whole = decontaminate.hits(docs, benchmark, keep=["doc_id"])
    sliced = decontaminate.hits(docs, benchmark, keep=["doc_id"], slice_bytes=40)
    assert sorted(map(str, sliced.collect())) == sorted(map(str, whole.collect()))


def test_clean_documents_stay(spark, documents):
    docs, benchmark = run(spark, documents, DOCS, ITEMS)
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect())) == sorted(d[0] for d in brute(DOCS, ITEMS) if not d[-1])


def test_empty_tables(spark, documents):
    docs, benchmark = run(spark, documents, DOCS, ITEMS)
    assert decontaminate.decontamination_report(docs.limit(0), benchmark).collect() == []
    got = sorted(map(tuple, decontaminate.decontamination_report(docs, benchmark.limit(0)).collect()), key=str)
    assert got == brute(DOCS, [])


def test_no_slice_outgrows_the_bound_of_broadcasts(spark, documents, monkeypatch):
    """Short words, whose arrays are many times their bytes, and an item longer than a slice."""
    long = " ".join(str(i % 997) for i in range(3000))
    items = [(i, " ".join(f"{i % 7}{k % 10}" for k in range(100))) for i in range(40)] + [(50, long), (51, "two words")]
    parts = long.split()
    docs = [(1, " ".join(parts[a : a + 30])) for a in range(0, 2900, 290)] + [(2, long), (3, "with two words"), (4, items[3][1]), (5, "1 2 3"), (6, None)]
    monkeypatch.setattr(shared, "BROADCAST_BYTES", 60_000)
    given, benchmark = run(spark, documents, docs, items)
    assert sorted(map(tuple, decontaminate.decontamination_report(given, benchmark).collect()), key=str) == brute(docs, items)


def test_the_bytes_of_a_slice_are_counted_from_above():
    for n in (1, 2, 3, 8):
        items = [(str(i), [f"{(i * 100 + k) % 36**n:0{n}d}"[:n].encode() for k in range(100)]) for i in range(300)]
        part = decontaminate.Slice(items, 10)
        prefixes = part.prefixes({k: np.zeros(len(v), np.int64) for k, v in part.shingles.items()})
        bound = decontaminate.FIXED_BYTES + sum(len(name) + decontaminate.ITEM_BYTES + sum(map(len, said)) + decontaminate.WORD_BYTES * len(said) for name, said in items)
        assert len(cloudpickle.dumps((part, prefixes))) <= bound
