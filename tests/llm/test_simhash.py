import random
import re

import numpy as np
import pytest
import xxhash

from agencylens.llm import graph, simhash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, radius=3):
    """Least position reachable, over all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def clustered(n, seed=5):
    """Fingerprints at 0 to 5 bits from few centres, some in chains."""
    rng = random.Random(seed)
    out, centre = set(), rng.getrandbits(64)
    while len(out) < n:
        if rng.random() < 0.1:
            centre = rng.getrandbits(64)
        value = centre
        for _ in range(rng.randint(0, 5)):
            value ^= 1 << rng.randrange(64)
        out.add(value)
        if rng.random() < 0.3:
            centre = value
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_distances(radius):
    values = clustered(150)
    rows = np.array(values, np.uint64)
    got = simhash.within(rows[:70], rows, radius)
    assert (got == [[(a ^ b).bit_count() <= radius for b in values] for a in values[:70]]).all()


def test_forest_keeps_every_component():
    values = clustered(600)
    assert simhash.forest(np.array(values, np.uint64)).tolist() == classes(values)


def test_majority_over_several_chunks(monkeypatch):
    hashes = np.random.default_rng(0).integers(0, 2**63, 1000).astype(np.uint64)
    whole = simhash.majority(hashes)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.majority(hashes) == whole and simhash.majority(hashes[:0]) == 0


@pytest.mark.parametrize("tile", [simhash.TILE, 8])
def test_links_join_what_all_pairs_join(spark, tile):
    """With a small tile every shared key is hot and dealt into tiles."""
    values = clustered(400, seed=9)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), tile=tile)
    pairs = [(r["u"], r["v"]) for r in edges.collect()]
    assert all(((u ^ v) & (1 << 64) - 1).bit_count() <= 3 or tile for u, v in pairs)
    rooted = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    place = {v: i for i, v in enumerate(signed)}
    expected = classes(values)
    least = {}
    for v in signed:
        least[expected[place[v]]] = min(v, least.get(expected[place[v]], v))
    assert {v: rooted.get(v, v) for v in signed} == {v: least[expected[place[v]]] for v in signed}


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, 501 + i) for i in range(200)] + [(9000, 9000)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {500 + i: 500 for i in range(201)}
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


BASE = " ".join(f"w{i * 7 % 211}" for i in range(900))
TEXTS = [(3, BASE), (2, BASE.replace("w7 ", "W7\n", 1)), (9, BASE.replace("w70 ", "v70 ", 1)), (1, "other text altogether"), (5, None), (4, ""), (6, " \t"), (7, "one"), (8, "one two"), (8, "one two"), (None, BASE), (None, "lone"), (10, "long " * 40_000)]


def test_report_equals_brute_force(documents):
    got = simhash.near_duplicates(documents(TEXTS)).collect()
    values = [fingerprint(t) for _, t in TEXTS]
    roots = classes(values)
    least = {}
    for (doc_id, _), r in zip(TEXTS, roots):
        least[r] = min((i for i in (doc_id, least.get(r)) if i is not None), default=None)
    expected = [(i, f"{v:016x}", least[r]) for (i, _), v, r in zip(TEXTS, values, roots)]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_empty_table(documents):
    none = documents(TEXTS).limit(0)
    assert simhash.near_duplicates(none).collect() == []
