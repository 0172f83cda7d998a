import hashlib
import re
from itertools import product

import numpy as np
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from agencylens.llm import pii

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789.@+- ()ab%é\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert [tuple(s) for s in pii.base_spans(text)[0]] == plain(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "a@" * 100_000, "1-" * 100_000, "(" * 200_000):
        pii.spans(text + " x@y.zz", pii.prior())


CARD, DECOY = "4952935900253052", "9807915762804490"


def added(text):
    return [(pii.KINDS[s.kind], text[s.start : s.end]) for s in pii.spans(text, pii.prior())[1]]


def test_repeated_values_share_their_label():
    assert added(f"card {CARD} again 4952.9359.0025.3052.") == [("card", "4952.9359.0025.3052")]
    assert added("mail a.b@mail.example.com or a.b (at) mail.example (dot) com") == [("email", "a.b (at) mail.example (dot) com")]
    assert added("call +1 (017) 555-7713 or 017/555.7713") == [("phone", "017/555.7713")]


def test_plain_repeats_of_a_number():
    assert added("call +1 (017) 555-7713 or 017-555-7713") == [("phone", "017-555-7713")]
    assert added("call +10175557713, that is 0175557713.") == [("phone", "0175557713")]
    assert added("+10175557713, 0175557713, 017-555-7713") == [("phone", "0175557713"), ("phone", "017-555-7713")]
    assert added(f"{CARD} and {DECOY} {CARD}") == [("card", CARD)]  # the pattern takes both for one number
    assert added("0175557713 first, then +10175557713 and 0175557713") == [("phone", "0175557713")] * 2


def test_others_are_left_alone():
    assert added(f"{CARD} {DECOY} 9807.9157.6280.4490 and {DECOY}") == []
    assert added("17.5.2020 to 18/06/2021, 1.000.000.000 at 97.51.17.173") == []
    assert added("no (at) all, 12 345 678") == []
    assert added(f"+1 (017) 555-7713 is not {DECOY}, nor 018-555-7713 or 018-555-7713") == []


def test_report(documents):
    long = "x " * 60_000 + f"{CARD} end"
    rows = [(1, f"é {CARD} a@b.cc +1 (017) 555-7713 1.2.3.4"), (2, None), (3, ""), (4, "clean text 12"), (4, "clean text 12"), (None, "a@b.cc"), (5, long), (6, f"{CARD} or 4952.9359.0025.3052")]
    docs = documents(rows)
    got = sorted(map(tuple, pii.pii_report(docs).collect()), key=str)
    assert len(got) == len(rows)
    for doc_id, text in rows:
        base = plain(text or "")
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        counts = tuple(sum(k == kind for _, k, _ in base) for kind in range(4))
        extra = ",card:20:39" if doc_id == 6 else ""
        assert (doc_id, *counts, hashlib.sha256(said.encode()).hexdigest(), said + extra) in got
    assert pii.pii_report(docs.limit(0)).collect() == []


def test_marginals_sum_to_one():
    text = f"{CARD} x " * 5 + "4952.9359.0025.3052 x " * 5
    own = pii.nodes(text, *pii.base_spans(text))
    sure = pii.marginals(own, pii.prior())
    assert abs(sure.sum(axis=1) - 1).max() < 1e-9 and len(own) == 10


def enumerated(own, weights):
    """Marginals by the sum over every labelling."""
    k = len(pii.LABELS)
    unary = [weights.unary[[*n.shape, n.rule]].sum(axis=0) for n in own]
    unary = [np.where(np.arange(k) == n.rule, 0.0, -50.0) if n.rule <= 4 else u for n, u in zip(own, unary, strict=True)]
    edges = [(i, i + 1, weights.chain) for i in range(len(own) - 1)] + [(i, j, weights.skip) for i, j in pii.skips(own)]
    total = np.zeros((len(own), k))
    for labels in product(range(k), repeat=len(own)):
        p = np.exp(sum(u[y] for u, y in zip(unary, labels, strict=True)) + sum(w[labels[i], labels[j]] for i, j, w in edges))
        total[np.arange(len(own)), labels] += p
    return total / total.sum(axis=1, keepdims=True)


def _weights(chained):
    rng = np.random.default_rng(3)
    chain = rng.normal(0, 0.4, (5, 5)) * chained
    return pii.Weights(rng.normal(0, 0.6, pii.prior().unary.shape), chain + chain.T, np.eye(5) * 1.5)


def test_marginals_equal_an_enumeration():
    text = f"x 4952.9359.0025.3052 and {CARD}, {DECOY}, 017/555.7713 then 4952/9359/0025/3052"
    own = pii.nodes(text, *pii.base_spans(text))
    assert len(own) == 5 and len(pii.skips(own)) == 2
    for weights, bound in ((_weights(0), 1e-6), (_weights(1), 0.05)):  # a forest is exact, loops are close
        assert abs(pii.marginals(own, weights, rounds=60) - enumerated(own, weights)).max() < bound


def test_ids_of_text(documents):
    docs = documents([(1, f"{CARD} or 4952.9359.0025.3052"), (2, None)]).withColumn("doc_id", F.concat(F.lit("a"), "doc_id"))
    assert {(r["doc_id"], r["n_card"]) for r in pii.pii_report(docs).collect()} == {("a1", 1), ("a2", 0)}
