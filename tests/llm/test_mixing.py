from collections import Counter
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from agencylens.llm import mixing


def water(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Excess handed on until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        rest = budget - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        goal = {s: most * sizes[s] if s in capped else rest * weight[s] / free for s in order}
        over = {s for s in order if s not in capped and goal[s] > most * sizes[s]}
        if not over:
            return goal
        capped |= over


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 5), min_size=1, max_size=4), st.integers(0, 300))
def test_fit_reaches_the_best_sum(counts, budget):
    lengths, have = np.array(list(counts)), np.array(list(counts.values()))
    best = max((s for s in {int(np.dot(lengths, c)) for c in product(*(range(h + 1) for h in have))} if s <= budget))
    # exact when all of the budget is left to dynamic programming
    taken = mixing.fit(lengths, have, budget, exact_budget=1 << 20)
    assert (taken >= 0).all() and (taken <= have).all()
    got = int((taken * lengths).sum())
    assert got <= budget and best - got <= lengths.max()
    if budget >= int((lengths * have).sum()):
        assert (taken == have).all()


def test_fit_of_a_large_budget():
    rng = np.random.default_rng(3)
    lengths = np.unique(rng.integers(1, 20_000, 3000))
    counts = rng.integers(1, 10**7, len(lengths))
    budget = int((lengths * counts).sum() * 0.37)
    taken = mixing.fit(lengths, counts, budget)
    assert (taken <= counts).all() and int((taken * lengths).sum()) == budget


def test_targets_fill_like_handed_on_excess(spark):
    sizes = {"b": 10, "a": 1000, "é": 0, None: 77, "Z": 300, "c": 5}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(water(sizes))


def test_mix_of_a_hot_length(documents):
    rows = [(i, "one two three", "en", "hot") for i in range(600)] + [(1000 + i, "word " * (i % 17), "en", f"s{i % 3}") for i in range(300)]
    rows += [(5000, None, None, None), (5001, "", None, None), (None, "a b", None, "s1"), (None, "a b", None, "s1"), (5002, "only one", None, None)]
    docs = documents(rows)
    got = mixing.mixing_report(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert sorted(map(tuple, mixing.mixing_report(docs.repartition(7)).collect()), key=str) == sorted(map(tuple, got), key=str)
    sizes = {}
    for r in rows:
        sizes[r[3] if len(r) > 3 else None] = sizes.get(r[3], 0) + len((r[1] or "").replace(" ", "_").split())
    goals, taken = water(sizes), Counter()
    by_id = {r[0]: r[3] for r in rows}
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        assert r["target"] == pytest.approx(goals[by_id[r["doc_id"]]]) and r["source_size"] == sizes[by_id[r["doc_id"]]]
        taken[by_id[r["doc_id"]]] += r["taken"]
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= 17, source


def test_the_mix_itself(documents):
    docs = documents([(i, "w " * (1 + i % 5), "en", f"s{i % 4}") for i in range(40)])
    copies = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mixing_report(docs).collect()}
    mix = mixing.taken(docs)
    assert mix.columns == docs.columns
    assert Counter(r["doc_id"] for r in mix.collect()) == Counter({k: v for k, v in copies.items() if v})


def test_empty_tables(documents, spark):
    none = documents([(1, "a", None, None)]).limit(0)
    assert mixing.mixing_report(none).collect() == [] and mixing.taken(none).collect() == []
    assert mixing.mixing_report(documents([(1, None), (2, "")])).select("taken").distinct().collect() == [(0,)]
