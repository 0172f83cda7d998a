import hashlib
import zlib

from pyspark.sql import functions as F

from agencylens.llm import merkle
from agencylens.llm.shared import table


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][k : k + 3])) for k in range(0, len(levels[-1]), 3)])
    return levels


def climb(levels, i):
    for nodes in levels[:-1]:
        start = i - i % 3
        yield "".join(nodes[start:i]), "".join(nodes[i + 1 : start + 3])
        i //= 3


def brute(rows):
    rows = [r.asDict() for r in rows]
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r["source"] == s), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]))) for s in sources}
    trees = {s: tree([leaf(r, r["text"]) for r in own[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    for k, s in enumerate(sources):
        for i, r in enumerate(own[s]):
            path = [*climb(trees[s], i), *climb(top, k)]
            even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            now = leaf(r, r["text"].replace("\n", "") if even and r["text"] is not None else r["text"])
            for before, after in path:
                now = h(before + now + after)
            yield r["doc_id"], trees[s][0][i], trees[s][-1][0], top[-1][0], h("".join(a + b for a, b in path)), now, now == top[-1][0]


def equal(docs):
    report = merkle.manifest_report(docs)
    assert report.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = [tuple(r) for r in report.collect()]
    assert sorted(found, key=str) == sorted(brute(docs.collect()), key=str)
    return found


def test_equals_a_plain_tree(spark, small):
    found = equal(table(spark, small, "documents"))
    assert {r[-1] for r in found} == {True, False}


def test_sizes_around_a_subtree(documents):
    equal(documents([(100 * n + k, f"a\n{k}", None, f"of {n}") for n in (1, 2, 3, 4, 9, 10, 27, 28, 82) for k in range(n)]))


def test_one_source_of_one_row(documents):
    (row,) = equal(documents([(1, "a\nb", "en", "s")]))
    assert row[1] == row[2] == row[3]


def test_nulls_ties_and_long_texts(documents):
    rows = [(1, "a\nb", "en", "s"), (1, "a\nb", "en", "s"), (1, "c", "en", "s"), (None, None, None, None), (None, "", None, None), (2, "", "é", "S"), (3, "x\n" * 400_000, "en", "-"), (4, "\n", "en", ":")]
    found = equal(documents(rows))
    assert len({r[3] for r in found}) == 1


def test_many_sources_make_a_tall_upper_tree(documents):
    equal(documents([(k, "t", "en", f"s{k:03d}") for k in range(100)] + [(200 + k, "u", "en", "s000") for k in range(40)]))


def test_empty_table(documents):
    assert merkle.manifest_report(documents([])).collect() == []


def test_only_every_third_level_is_stored_and_proofs_hold(spark):
    rows = spark.range(100).select(F.col("id"), F.col("id").cast("string").alias("path"))
    leaves = rows.select(F.lit("t").alias("tree"), F.col("id").alias("key"), merkle.hashed(merkle.field(F.col("id"))).alias("hash"))
    levels = merkle.built(merkle._placed(leaves, "key"))
    assert [level.count() for level in levels] == [100, 4, 1]
    root = levels[-1].first()["hash"]
    found = merkle.manifest(rows, F.lit(None).cast("string"), F.col("id"), merkle.hashed(merkle.field(F.col("id"))))
    assert {r["root"] for r in found.select("root").collect()} == {root}
    assert found.filter(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert found.filter(merkle.folded(F.sha2(F.col("leaf"), 256), F.col("path")) == F.col("root")).count() == 0
