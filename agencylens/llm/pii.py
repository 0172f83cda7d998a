"""Personal data by a skip-chain conditional random field over a document's candidate tokens.

Base spans follow fixed patterns and always stay. Nodes of the field are the base spans, plain numbers that fail their
kind's check, and tokens in other formats (dotted or slashed numbers, spelled-out addresses) whose label no pattern tells.
Chain edges join neighbours. Skip edges join distant nodes of the same value, its digits or its address in canonical form,
or of the same number with and without its leading digits. Loopy message passing makes their labels agree, and a token
whose marginal for a kind reaches `SURE` is a span too. A number that failed a check, but that skip edges join with a base
span, is such a token: its pattern was not the one that it follows. So a number that was written in one place as the
patterns know it is found in every place of the document, while other numbers that fail a check are left alone. A document
without a base span has nothing to agree with and gains none.

Every text is walked whole, however long. Repeated rows are found alike, row by row; the original columns travel in one
struct, so no column name clashes; a doc_id of another type than an integer keeps its type. Repeated ids of the sample send
all their rows to the field's training, of which `TRAIN_NODES` nodes are kept. An empty table gives an empty result.

The weights are learned by pseudo-likelihood, pulled towards `PRIOR_SAME` for equal labels on skip edges, from the nodes of
at most `TRAIN_ROWS` documents, those with the smallest hash of their id, and `TRAIN_NODES` nodes in all, their base spans
serving as labels; half of the nodes hide what their pattern says, so that the rest of the features and the edges must
tell. Documents are independent; texts stream through without a shuffle. A null text is an empty one.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from agencylens.llm.shared import packed, shipped

#: Fixed value: the kinds in order.
KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
TRAIN_ROWS, TRAIN_NODES = 4096, 1 << 16
PRIOR_SAME, SURE, ROUNDS, DAMPING = 5.0, 0.9, 12, 0.5
#: Digits that two numbers must share at their ends to be joined.
SHARED_DIGITS = 9
#: Fixed value: the digits of the longest number of any kind.
MOST_DIGITS = 19

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"\+?\(?[0-9](?:(?![,.:;]\x20)[\x20().,/_: ‐-―-]{0,2}[0-9]){8,}")
_SPACED = re.compile(r"[^\x20]+")
_AT = re.compile(r"[ \t]?(?:@|[(\[{][ \t]?(?:at|AT|@)[ \t]?[)\]}])[ \t]?")
_NAME = re.compile(r"[\w.%+-]")
_HOST = re.compile(r"[\w-]+(?:[ \t]?(?:\.|[(\[{][ \t]?(?:dot|DOT|\.)[ \t]?[)\]}])[ \t]?[\w-]+)+")
_MARKER = re.compile(r"[ \t]?[(\[{][ \t]?(at|dot|@|\.)[ \t]?[)\]}][ \t]?", re.I)


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _digits(said: str) -> str:
    return "".join(c for c in said if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """Around each @: the run before it, which no earlier match has used, and a domain after it."""
    used = at = 0  # each run is walked once: an @ ends it
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > used and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        at += 1
        if domain:
            yield Span(start, 0, domain.end())
            used = at = domain.end()


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Places of addresses whose signs may be spelled out: around each sign, the run before it and a host after it."""
    used = 0
    for sign in _AT.finditer(text):
        start = sign.start()
        while start > used and _NAME.match(text[start - 1]):
            start -= 1
        host = _HOST.match(text, sign.end()) if start < sign.start() else None
        if host:
            yield start, host.end()
        used = host.end() if host else sign.start()


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The spans of the fixed patterns by start and kind; and the plain numbers that matched one and failed its check."""
    good: list[Span] = list(_emails(text)) if "@" in text else []
    failed: list[Span] = []
    for m in _IP.finditer(text):
        fits = all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))
        (good if fits else failed).append(Span(m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        fits = 12 <= len(digits) <= 19 and luhn(digits)
        (good if fits else failed).append(Span(m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            fits = 9 <= len(_digits(m[0])) <= 15
            (good if fits else failed).append(Span(m.start(), 3, m.end()))
    return sorted(good), failed


class Node(NamedTuple):
    start: int
    end: int
    key: str
    #: features that any token has
    shape: tuple[int, ...]
    #: what a pattern says: kind + 1 of a base span, 5 of a number that failed, 6 of another format or joined with a base span
    rule: int


N_FEATURES = 16


def _shape(said: str, key: str) -> tuple[int, ...]:
    if "@" in key:
        return (0, 7)
    n = len(key)
    size = 9 if n < 9 else 10 if n < 12 else 11 if n < 16 else 12 if n < 20 else 13
    return (0, size, *((8,) if said.startswith("+") else ()), 14 if "." in said else 15)


def _key(said: str) -> str:
    address = _MARKER.sub(lambda m: "@" if m[1].lower() in ("at", "@") else ".", said)
    return re.sub(r"[ \t]", "", address).lower() if "@" in address else _digits(said)


def _numbers(run: re.Match[str]) -> Iterator[tuple[int, int]]:
    """A run of digits; of one that is longer than any kind, the parts between spaces that can be a number."""
    parts = [run] if len(_digits(run[0])) <= MOST_DIGITS else _SPACED.finditer(run.string, run.start(), run.end())
    for part in parts:
        if SHARED_DIGITS <= len(_digits(part[0])) <= MOST_DIGITS:
            yield part.start(), part.end()


class _Cover:
    """The places that some spans cover."""

    def __init__(self, spans: list[Span]) -> None:
        self.ends: list[int] = []
        self.starts: list[int] = []
        for span in sorted(spans):
            if self.ends and span.start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], span.end)
            else:
                self.starts.append(span.start)
                self.ends.append(span.end)

    def gaps(self, end: int) -> Iterator[tuple[int, int]]:
        return zip([0, *self.ends], [*self.starts, end], strict=True)

    def meets(self, start: int, end: int) -> bool:
        at = bisect_right(self.ends, start)
        return at < len(self.starts) and self.starts[at] < end


def nodes(text: str, good: list[Span], failed: list[Span]) -> list[Node]:
    """Base spans and candidates by start; a candidate that touches a base span is none."""
    out = [(s.start, s.end, s.kind + 1) for s in good]
    taken, plain = _Cover(good), _Cover([s for s in failed if s.kind != 1 and s.end - s.start >= SHARED_DIGITS])
    found = [part for a, b in taken.gaps(len(text)) for m in _NUMBER.finditer(text, a, b) for part in _numbers(m)]
    if "@" in text or "(" in text or "[" in text or "{" in text:
        found += list(_addresses(text))
    out += [(a, b, 5 if plain.meets(a, b) else 6) for a, b in found if not taken.meets(a, b)]
    return released([Node(a, b, key := _key(text[a:b]), _shape(text[a:b], key), rule) for a, b, rule in sorted(out)])


def released(own: list[Node]) -> list[Node]:
    """Numbers that failed a check, but that skip edges join with a base span, as tokens whose label no pattern tells."""
    first = list(range(len(own)))
    for i, j in skips(own):  # each node has at most one edge to an earlier one
        first[j] = first[i]
    agreeing = {first[i] for i, n in enumerate(own) if n.rule <= len(KINDS)}
    return [n._replace(rule=6) if n.rule == 5 and first[i] in agreeing else n for i, n in enumerate(own)]


def skips(own: list[Node]) -> list[tuple[int, int]]:
    """Skip edges: each node with the previous one of its value, and values with the value of which they are the end."""
    edges, last = [], {}
    ends: dict[str, str] = {}
    for i, node in enumerate(own):
        if node.key in last:
            edges.append((last[node.key], i))
        elif len(node.key) >= SHARED_DIGITS and "@" not in node.key:
            other = ends.setdefault(node.key[-SHARED_DIGITS:], node.key)
            if other != node.key and (other.endswith(node.key) or node.key.endswith(other) or other.endswith(node.key.lstrip("0"))):
                edges.append((last[other], i))
        last[node.key] = i
    return edges


class Weights(NamedTuple):
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def prior() -> Weights:
    unary = np.zeros((N_FEATURES, len(LABELS)))
    unary[0, 0] = 1.0
    for kind in range(len(KINDS)):
        unary[kind + 1, kind + 1] = 6.0
    unary[5, 0] = 6.0
    return Weights(unary, np.zeros((len(LABELS),) * 2), np.eye(len(LABELS)) * PRIOR_SAME)


def train(documents: list[list[Node]], steps: int = 200, rate: float = 0.5, pull: float = 0.02) -> Weights:
    """Pseudo-likelihood by gradient ascent: each node's label given its features and its neighbours' labels."""
    weights = prior()
    start = prior()
    features, labels, pairs = [], [], {"chain": [], "skip": []}
    for every in documents:
        own = [n for n in every if n.rule != 6]  # no pattern says what the others are
        base = len(labels)
        for node in own:
            hidden = len(labels) % 2 == 1
            row = np.zeros(N_FEATURES)
            row[list(node.shape)] = 1
            row[6 if hidden else node.rule] = 1
            features.append(row)
            labels.append(node.rule if node.rule <= len(KINDS) else 0)
        pairs["chain"] += [(base + i, base + i + 1) for i in range(len(own) - 1)]
        pairs["skip"] += [(base + i, base + j) for i, j in skips(own)]
    if not labels:
        return weights
    x, y = np.array(features), np.array(labels)
    hot = np.eye(len(LABELS))[y]
    around = {}
    for name, edges in pairs.items():
        around[name] = np.zeros_like(hot)
        for i, j in edges:
            around[name][i] += hot[j]
            around[name][j] += hot[i]
    for _ in range(steps):
        logits = x @ weights.unary + around["chain"] @ weights.chain + around["skip"] @ weights.skip
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        gap = (hot - p / p.sum(axis=1, keepdims=True)) / len(y)
        moved = []
        for own, first, seen in zip(weights, start, (x, around["chain"], around["skip"]), strict=True):
            step = seen.T @ gap
            if own.shape[0] == len(LABELS):
                step = (step + step.T) / 2
            moved.append(own + rate * (step - pull * (own - first)))
        weights = Weights(*moved)
    return weights


def marginals(own: list[Node], weights: Weights, rounds: int = ROUNDS) -> np.ndarray:
    """(node, label) by loopy sum-product in logarithms, damped; base spans are held to their kind."""
    unary = np.array([weights.unary[[*n.shape, n.rule]].sum(axis=0) for n in own])
    for i, n in enumerate(own):
        if n.rule <= len(KINDS):
            unary[i] = np.where(np.arange(len(LABELS)) == n.rule, 0.0, -50.0)
    edges = [(i, i + 1, 0) for i in range(len(own) - 1)] + [(i, j, 1) for i, j in skips(own)]
    if not edges:
        belief = unary
    else:
        ends = np.array(edges)
        source, target = np.append(ends[:, 0], ends[:, 1]), np.append(ends[:, 1], ends[:, 0])
        potential = np.stack([weights.chain, weights.skip])[np.append(ends[:, 2], ends[:, 2])]
        back = np.append(np.arange(len(ends)) + len(ends), np.arange(len(ends)))
        sent = np.zeros((2 * len(ends), len(LABELS)))
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, target, sent)
            new = np.logaddexp.reduce((belief[source] - sent[back])[:, :, None] + potential, axis=1)
            sent = DAMPING * sent + (1 - DAMPING) * (new - np.logaddexp.reduce(new, axis=1)[:, None])
        belief = unary.copy()
        np.add.at(belief, target, sent)
    return np.exp(belief - np.logaddexp.reduce(belief, axis=1)[:, None])


def spans(text: str | None, weights: Weights) -> tuple[list[Span], list[Span]]:
    """Base spans, and those that the field adds."""
    if not text:
        return [], []
    good, failed = base_spans(text)
    if not good:  # without an entity no token of another format has one to agree with
        return [], []
    own = nodes(text, good, failed)
    if all(n.rule != 6 for n in own):
        return good, []
    sure = marginals(own, weights)
    added = [Span(n.start, int(p[1:].argmax()), n.end) for n, p in zip(own, sure, strict=True) if n.rule == 6 and p[1:].max() >= SURE]
    return good, added


def fit(docs: DataFrame) -> Weights:
    """The weights, from a bounded sample of documents."""
    sample = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS).select(F.col("doc_id").alias("id")).distinct()
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id"))  # TRAIN_ROWS ids at most

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("id"), batch.column("text"), strict=True):
                said = text.as_py() or ""
                rows += [(doc_id.as_py(), *node) for node in nodes(said, *base_spans(said))]
            types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.int64())
            columns = list(zip(*rows, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["id", "start", "end", "key", "shape", "rule"])

    schema = "id string, start long, end long, key string, shape array<long>, rule long"
    rows = texts.select(F.col("id").cast("string").alias("id"), "text").mapInArrow(found, schema).orderBy(F.xxhash64("id"), "id", "start", "end").limit(TRAIN_NODES).collect()
    documents: dict[str, list[Node]] = {}
    for r in rows:
        documents.setdefault(r["id"], []).append(Node(r["start"], r["end"], r["key"], tuple(r["shape"]), r["rule"]))
    return train(list(documents.values()))


def detected(docs: DataFrame, weights: Weights, keep: list[str] | None = None) -> DataFrame:
    """Struct `doc` of the kept columns, `base` and `added`: the spans (kind, start, end; code points, end exclusive) of every whole text."""
    rows = packed(docs, keep, text=F.col("text"))
    shared = shipped(docs.sparkSession, weights, "the weights")
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            both = [spans(text.as_py(), weights) for text in batch.column("text")]
            columns = [pa.array([[{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in b[k]] for b in both], pa.list_(span)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns], ["doc", "base", "added"])

    listed = "array<struct<kind:string,start:bigint,end:bigint>>"
    return rows.mapInArrow(detect, f"doc {rows.schema['doc'].dataType.simpleString()}, base {listed}, added {listed}")


def _is(kind: str):
    return lambda k: k == kind


def pii_report(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, the number of base spans of each kind, base_sha256, spans."""

    def joined(listed):
        place = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
        ordered = F.array_sort(F.transform(listed, lambda s: F.struct(s["start"].alias("start"), place(s).alias("place"), s["kind"].alias("kind"), s["end"].alias("end"))))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = detected(docs, fit(docs), keep=["doc_id"])
    counts = [F.size(F.filter("base.kind", _is(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc.doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))
