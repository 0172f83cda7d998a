import random

import numpy as np
import pytest

import corpus_pipeline
from agencylens.llm import similar


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def survivors(docs):
    """Least doc_id of every group of documents at 0.8 or more, over all pairs."""
    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(least.values())


def near_copies(seed=3):
    """Texts at all similarities around 0.8, in stars and chains, some with a common passage or of few words."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage, docs = [word() for _ in range(60)], []
    for _ in range(30):
        said = [word() for _ in range(rng.choice([3, 5, 12, 40, 90, 150]))]
        if rng.random() < 0.3:
            said = said[:20] + passage
        for _ in range(rng.randint(1, 6)):
            copy = list(said)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                said = copy
            docs.append(" ".join(copy))
    rng.shuffle(docs)
    return list(enumerate([*docs, None, "", " \n"]))


@pytest.mark.parametrize("changed", [{}, {"_LIMIT": -(2**63)}, {"HOT": 1, "SPREAD": 2}, {"TILE": 2, "OFFERS": 1}, {"MANY": 2, "_LIMIT": 2**63 - 1}])
def test_the_stage_keeps_what_all_pairs_keep(spark, documents, monkeypatch, changed):
    """With any order of the shingles, hot buckets in tiles and one offer a round, the same documents stay."""
    for name, value in changed.items():
        monkeypatch.setattr(similar, name, value)
    rows = near_copies()
    docs = documents(rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, None)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == survivors(rows)


def test_pairs_of_a_large_group_grow_with_its_sets(spark, documents, monkeypatch):
    """2,000 near copies of one text, one or two words changed: few rounds, none of more pairs than sets times its offers."""
    rng, rounds = random.Random(5), []
    base = [f"w{rng.randrange(5000)}" for _ in range(100)]
    texts = set()
    while len(texts) < 2000:
        copy = list(base)
        for _ in range(rng.randint(1, 2)):
            copy[rng.randrange(100)] = f"w{rng.randrange(5000)}"
        texts.add(" ".join(copy))
    verified = similar._verified

    def counted(pairs, texts):
        found = verified(pairs, texts)
        rounds.append(found.count())
        return found

    monkeypatch.setattr(similar, "_verified", counted)
    rows = list(enumerate(sorted(texts)))
    kept = similar.deduplicated(documents(rows)).count()
    sets = [shingles(t) for _, t in rows]
    linked = set()  # by the places of the changed words: copies of one change, or of two that agree, are similar
    for i in range(1, len(sets)):
        for j in range(i):
            if i - j < 40 and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                linked.add(i)
                break
    assert kept <= len(sets) - len(linked) and len(rounds) <= 12
    assert all(n <= (3 if k == 0 else 4**k) * len(sets) for k, n in enumerate(rounds)) and sum(rounds) <= 8 * len(sets), rounds


def test_orders_split_a_set(monkeypatch):
    rng = np.random.default_rng(2)
    own = np.unique(rng.integers(-(2**63), 2**63 - 1, 50))
    hot = np.sort(rng.choice(own, 20, replace=False))
    order = similar.Order(hot, rng.integers(1, 9, 20))
    for limit in (-(2**63), 0, 2**63 - 1):
        monkeypatch.setattr(similar, "_LIMIT", limit)
        early, late = order.split(own)
        assert order.counted(own).sum() == len(early) and not np.isin(early, hot).any()
        assert len(np.unique(np.append(early, late))) == max(len(early), similar.prefix_length(len(own)))


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(100):
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, rng.integers(0, 700)))
        b = np.unique(np.append(a[rng.random(len(a)) < 0.9], rng.integers(-(2**63), 2**63 - 1, rng.integers(0, 90))))
        bits = [np.unpackbits(np.frombuffer(similar.parities(x), np.uint8)) for x in (a, b)]
        assert (bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))


def test_very_long_and_clashing(spark, documents):
    long = " ".join(f"w{k}" for k in range(60_000))
    docs = documents([(1, long), (2, long + " end"), (3, "short one"), (4, "")]).selectExpr("*", "'k' AS key", "'m' AS mark", "1L AS least", "2L AS id", "3L AS label")
    kept = similar.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_null_and_repeated_ids(spark, documents):
    docs = documents([(None, "a b c d e f"), (4, "A b c d e f"), (4, "a b c d e  f"), (None, "alone"), (None, "alone"), (9, "of its own")])
    kept = similar.deduplicated(docs).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == [4, 9, None]
    assert similar.deduplicated(docs.limit(0)).collect() == []
