import zlib
from collections import Counter, defaultdict
from hashlib import md5

from pyspark.sql import functions as F

from agencylens.llm import sharding


def jump(key: int, n: int) -> int:
    """The published loop."""
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def seed(key) -> int:
    return int(md5(("" if key is None else str(key)).encode()).hexdigest()[:16], 16)


def test_shards_equal_the_published_loop(spark):
    keys = spark.range(2000).select("id", *(c.alias(n) for n, c in zip(("high", "low"), sharding.key_words(F.col("id")))))
    for n in (1, 2, 8, 9, 64, 100):
        got = keys.select("id", sharding.jump_shard(F.col("high"), F.col("low"), n).alias("shard")).collect()
        assert [r["shard"] for r in got] == [jump(seed(r["id"]), n) for r in got], n


def test_rows_beyond_the_usual_draws(spark, monkeypatch):
    monkeypatch.setattr(sharding, "USUAL_DRAWS", 2)
    keys = spark.range(300).select("id", *(c.alias(n) for n, c in zip(("high", "low"), sharding.key_words(F.col("id")))))
    got = keys.select("id", sharding.jump_shard(F.col("high"), F.col("low"), 40).alias("shard")).collect()
    assert [r["shard"] for r in got] == [jump(seed(r["id"]), 40) for r in got]


def test_report(documents):
    rows = [(i, f"tëxt {i}") for i in range(500)] + [(7, "tëxt 7"), (7, "other"), (None, None), (None, "x"), (600, ""), (601, "long " * 50_000)]
    got = sharding.shard_report(documents(rows)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "key" and r["shard"] == jump(seed(r["doc_id"]), 8) and r["grown_shard"] in (r["shard"], 8) and r["grown_shard"] == jump(seed(r["doc_id"]), 9)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    assert sizes == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)


def test_empty_table(documents):
    assert sharding.shard_report(documents([(1, "a")]).limit(0)).collect() == []


def test_written_shards(documents, spark, tmp_path):
    docs = documents([(i, str(i)) for i in range(50)])
    assigned = sharding.sharded(docs, "doc_id", 4)
    sharding.write_shards(assigned, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["doc_id"], r["_shard"]) for r in back.collect()} == {(i, jump(seed(i), 4)) for i in range(50)}
