"""Benchmark decontamination: find every occurrence of every item-sized window of a benchmark in whole documents.

A prefix-filtered set join. A window of 10 item words (a whole item, if shorter) is a set of positioned shingles of three
words (of fewer, if it has fewer). Documents that contain the window contain all its shingles, so one is a necessary
prefix: the one that is rarest in all documents, counted in a first pass. The second pass joins the documents' shingles
with these prefixes only, drops what the prefix's position and the text's length rule out, and verifies the rest word for
word. Words are compared as numbers of the benchmark's own vocabulary, so nothing is hashed and nothing can collide.

Documents stream through both passes without a shuffle. The benchmark travels as a broadcast: its items are dealt into
slices whose word bytes stay under `slice_bytes` and whose arrays stay under the bound of broadcasts, and every slice
makes the two passes, carrying its hits with the row. The windows of an item too long for a slice are dealt over several
under the same id. So a benchmark of any size is exact and no broadcast outgrows the bound, unless a single word or id does.

Nulls: a null text has no words; a null item_id shows as the empty string. Repeated item_ids are one item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from agencylens.llm import shared as limits
from agencylens.llm.shared import packed, shipped

WINDOW = 10
SHINGLE = 3
SLICE_BYTES = 4 << 20
#: Pickled bytes of a slice at most: for a word beside its own (nine numbers of its window, its entry of the vocabulary), for an item beside its id, and for all else.
WORD_BYTES, ITEM_BYTES, FIXED_BYTES = 96, 16, 4096

#: A-Z to a-z; ASCII letters, digits and bytes beyond ASCII stay; all else is a space.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | bytes | None) -> list[bytes]:
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_BYTES).split()


class Slice:
    """Some benchmark items: vocabulary, windows and their shingles as sorted numbers.

    Word numbers start at 1 and 0 is any other word; a shingle is its word numbers read in base len(vocabulary) + 1, kept
    apart by its length. windows: (first word in `flat`, length, item).
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        flat: list[int] = []
        starts, lengths, owners = [], [], []
        for name, said in items:
            base = len(flat)
            flat.extend(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in said)
            size = min(window, len(said))
            for at in range(len(said) - size + 1 if said else 0):
                starts.append(base + at)
                lengths.append(size)
                owners.append(number[name])
        self.base = len(self.vocabulary) + 1
        self.flat = np.array(flat, np.int64)
        self.starts, self.lengths, self.owners = (np.array(x, np.int64) for x in (starts, lengths, owners))
        self.sizes = sorted({min(SHINGLE, n) for n in lengths})
        #: by shingle length: the benchmark's distinct shingles, sorted
        self.shingles = {n: np.unique(np.concatenate([self._shingles(k, n) for k in self._of(n)])) for n in self.sizes}

    def _of(self, n: int) -> np.ndarray:
        return np.flatnonzero(np.minimum(self.lengths, SHINGLE) == n)

    def _shingles(self, k: int, n: int) -> np.ndarray:
        return numbered(self.flat[self.starts[k] : self.starts[k] + self.lengths[k]], n, self.base)

    def prefixes(self, counts: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By shingle length: the prefix shingles sorted, where each one's windows begin in the next two, the window, the prefix's place in it."""
        out = {}
        for n in self.sizes:
            known, rows = self.shingles[n], []
            for k in self._of(n):
                own = self._shingles(k, n)
                seen = counts[n][np.searchsorted(known, own)]
                place = int(np.lexsort((own, seen))[0])  # the rarest; ties by number
                rows.append((int(own[place]), int(k), place))
            rows.sort()
            key, window, place = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            distinct, first = np.unique(key, return_index=True)
            out[n] = distinct, np.append(first, len(key)), window, place
        return out


def numbered(ids: np.ndarray, n: int, base: int) -> np.ndarray:
    """Shingles of n word numbers as numbers; -1 where a word is not the benchmark's. base ** 3 stays below 2 ** 63 up to two million words."""
    count = max(0, len(ids) - n + 1)
    out, known = np.zeros(count, np.int64), np.ones(count, bool)
    for k in range(n):
        part = ids[k : k + count]
        out = out * base + part
        known &= part > 0
    out[~known] = -1
    return out


def _found(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of `wanted` that are in the sorted `known`, and where there."""
    live = np.flatnonzero(wanted >= 0)
    at = np.searchsorted(known, wanted[live])
    hit = (at < len(known)) & (known[np.minimum(at, len(known) - 1)] == wanted[live])
    return live[hit], at[hit]


def _numbered_texts(column: pa.Array, vocabulary: dict[bytes, int]) -> Iterator[tuple[int, np.ndarray]]:
    get = vocabulary.get
    for i, value in enumerate(column):
        said = words(value.as_buffer().to_pybytes() if value.is_valid else None)
        yield i, np.fromiter((get(w, 0) for w in said), np.int64, len(said))


def _pieces(text: str, window: int, room: int) -> Iterator[list[bytes]]:
    """The words of an item in pieces of at most `room` bytes of a slice (of one window at least) that hold each of its windows once."""
    said: list[bytes] = []
    takes = 0
    for found in re.finditer(b"[^ ]+", text.encode().translate(_BYTES)):
        word = found.group()
        if len(said) >= window and takes + len(word) + WORD_BYTES > room:
            yield said
            said = said[len(said) - window + 1 :]
            takes = sum(map(len, said)) + WORD_BYTES * len(said)
        said.append(word)
        takes += len(word) + WORD_BYTES
    yield said


def _slices(benchmark: DataFrame, window: int, slice_bytes: int) -> Iterator[Slice]:
    """Slices of items in the order of item_id, each read by the driver on its own."""
    text = F.coalesce("text", F.lit(""))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), text.alias("text"))
    held: list[tuple[str, list[bytes]]] = []
    size = taken = 0
    room = limits.BROADCAST_BYTES - FIXED_BYTES
    for row in items.orderBy("item_id", "text").toLocalIterator():
        own = len(row["item_id"].encode()) + ITEM_BYTES
        for said in _pieces(row["text"], window, room - own):
            n_bytes = sum(map(len, said))
            takes = n_bytes + WORD_BYTES * len(said) + own
            if held and (size + n_bytes > slice_bytes or taken + takes > room):
                yield Slice(held, window)
                held, size, taken = [], 0, 0
            held.append((row["item_id"], said))
            size += n_bytes
            taken += takes
    yield Slice(held, window)


def _counts(texts: DataFrame, part: Slice) -> dict[int, np.ndarray]:
    """How often each of the slice's shingles occurs in all documents."""
    shared = shipped(texts.sparkSession, part, "a benchmark slice")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        totals = {n: np.zeros(len(own.shingles[n]), np.int64) for n in own.sizes}
        for batch in batches:
            for _, ids in _numbered_texts(batch.column("text"), own.vocabulary):
                for n in own.sizes:
                    np.add.at(totals[n], _found(own.shingles[n], numbered(ids, n, own.base))[1], 1)
        for n in own.sizes:
            seen = np.flatnonzero(totals[n])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), n, np.int32)), pa.array(seen), pa.array(totals[n][seen])], ["n", "place", "seen"])

    rows = texts.select("text").mapInArrow(count, "n int, place long, seen long").groupBy("n", "place").agg(F.sum("seen").alias("seen"))
    out = {n: np.zeros(len(part.shingles[n]), np.int64) for n in part.sizes}
    for row in rows.toLocalIterator():  # a number for each shingle of the slice at most
        out[row["n"]][row["place"]] = row["seen"]
    return out


def hits(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """For every document (struct `doc` of the kept columns): n_words, spans and items.

    spans: the hit words as (start, end) word positions, end exclusive, merged, in order. items: the ids, as strings and
    sorted, of the items of which a window occurs.
    """
    rows = packed(docs, keep, text=F.col("text"))
    rows = rows.select("doc", "text", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<long>").alias("marks"), F.array().cast("array<string>").alias("items"))
    doc_type = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {doc_type}, text string, n_words long, marks array<long>, items array<string>"
    texts = docs.select("text")
    for part in _slices(benchmark, window, slice_bytes):
        prefixes = part.prefixes(_counts(texts, part))
        shared = shipped(docs.sparkSession, (part, prefixes), "a benchmark slice")
        rows = rows.mapInArrow(_search(shared), schema)
    spans = F.transform(F.sequence(F.lit(0), F.size("marks") - 2, F.lit(2)), lambda i: F.struct(F.get("marks", i).alias("start"), F.get("marks", i + 1).alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return rows.select("doc", "n_words", F.when(F.size("marks") > 0, spans).otherwise(none).alias("spans"), F.array_sort(F.array_distinct("items")).alias("items"))


def _search(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, prefixes = shared.value
        for batch in batches:
            n_words, marks, items = [], [], []
            before, earlier = batch.column("marks"), batch.column("items")
            for i, ids in _numbered_texts(batch.column("text"), part.vocabulary):
                starts, owners, lengths = _occurrences(ids, part, prefixes)
                n_words.append(len(ids))
                known = before[i].as_py()
                if len(starts):
                    edges = [(int(a), int(a + n)) for a, n in zip(starts, lengths, strict=True)] + list(zip(known[::2], known[1::2], strict=True))
                    known = _merged(edges)
                marks.append(known)
                items.append(earlier[i].as_py() + [part.names[k] for k in np.unique(owners)])
            columns = [batch.column("doc"), batch.column("text"), pa.array(n_words, pa.int64()), pa.array(marks, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "text", "n_words", "marks", "items"])

    return search


def _occurrences(ids: np.ndarray, part: Slice, prefixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, item and length of every occurrence of a window among the document's words."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for n, (keys, first, window, place) in prefixes.items():
        at, key = _found(keys, numbered(ids, n, part.base))
        for k in np.unique(key):
            here = at[key == k]
            for w, offset in zip(window[first[k] : first[k + 1]], place[first[k] : first[k + 1]], strict=True):
                size = part.lengths[w]
                start = here - offset
                start = start[(start >= 0) & (start + size <= len(ids))]  # position and length bounds
                for step in range(size):  # exact, word for word; what differs goes at once
                    if not len(start):
                        break
                    start = start[ids[start + step] == part.flat[part.starts[w] + step]]
                if len(start):
                    found.append((start, np.full(len(start), part.owners[w]), np.full(len(start), size)))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _merged(edges: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(edges):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hits(docs, benchmark, keep=["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window, unchanged."""
    return hits(docs, benchmark).filter(F.size("spans") == 0).select("doc.*")


