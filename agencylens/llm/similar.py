"""Groups of near-duplicate documents: Jaccard similarity of their five-word shingles of 0.8 or more, exactly.

SimHash fingerprints (operator 6, over five words) propose the first pairs, which join most near copies; a prefix-filtered
set join proposes what they miss. Every proposed pair is verified on both whole texts, so components are those of all
pairs at 0.8 or more.

Order. A prefix is the first n - ceil(0.8 n) + 1 shingles of a set in one order for all sets; sets that are similar enough share
one. The order puts shingles of the lowest `RANGE` of all hashes first, the rarer ones before the others, counted over all
sets; then the other hashes; last the ones that a bounded sample shows to be in a 64th of the sets or more. Whether a shingle
is counted depends on its hash alone, so all sets agree. A set with a prefix of shingles that no other set has is done: it
has no partner. Only shingles that several sets have go on, and only where they are in the prefix.

Pairs. With each prefix shingle goes the parity of the set's shingles in 512 places. Two sets differ in as many shingles
as in parities at least, and similar ones in a ninth of both sizes at most, so a bucket's task rules out most pairs without
their texts. In each round a set offers only its first partners that are of another group and not tested: one at first, four
times as many in each further round. Pairs are verified, groups joined; rows without such a partner never come back. A round
ships as many pairs as open sets times the offers, however large a group is, and the rounds end when no bucket holds a pair
of different groups that is not ruled out. A bucket of more than `TILE` sets is dealt into tiles, and every two tiles meet
in a task of their own; their comparison of parities is the one step that is quadratic in a group's size.

Documents with equal sets are one node, known by 128 bits of its hash. Texts that are null, empty or without a word are one
set. One text is one value of its row; its hashes take 8 bytes a word. Rows that repeat doc_id and text are one; of others
the smallest doc_id stays (null last). Columns are carried in one struct, so no name clashes. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from agencylens.llm import simhash
from agencylens.llm.graph import components
from agencylens.llm.shared import discard, packed, shipped, stored
from agencylens.llm.shingles import run_hashes

SHINGLE = 5
#: The least similarity as a fraction.
LEAST, OF = 4, 5
#: Share of the hashes whose shingles are counted; counts of this many and more are one rank.
RANGE, MANY = 0.3, 1 << 16
#: Documents of the sample (expected number), the least number of them and the number of shingles that rank last.
SAMPLE, HOT, HOTTEST = 4096, 64, 1 << 16
#: Places of the parities, sets of a bucket's tile, pairs of a set that meet in one task, most offers of a set in a round.
PLACES, TILE, SPREAD, OFFERS = 512, 4096, 256, 64
#: Bits of the filter that keeps other documents' texts out of a shuffle.
FILTER_BITS = 1 << 25

_LIMIT = int(-(2.0**63) + RANGE * 2.0**64)


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted signed hashes of the distinct five-word shingles of a text in UTF-8; of all its words, if they are fewer."""
    return np.unique(run_hashes(text, SHINGLE).view(np.int64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= LEAST * (len(a) + len(b) - both)


def prefix_length(n: np.ndarray | int) -> np.ndarray | int:
    return (n > 0) * (n - -(-LEAST * n // OF) + 1)


def parities(own: np.ndarray) -> bytes:
    """For each place whether an odd number of the shingles fall on it."""
    return np.packbits(np.bincount(own & (PLACES - 1), minlength=PLACES) & 1).tobytes()


class Order:
    """The order's classes; `hot` are the shingles that come last, sorted, and `counts` their frequencies in the sample."""

    def __init__(self, hot: np.ndarray, counts: np.ndarray) -> None:
        self.hot, self.counts = hot, counts

    def _known(self, own: np.ndarray) -> np.ndarray:
        return self.hot[np.minimum(np.searchsorted(self.hot, own), len(self.hot) - 1)] == own if len(self.hot) else np.zeros(len(own), bool)

    def counted(self, own: np.ndarray) -> np.ndarray:
        """Which shingles are of the first class."""
        return (own < _LIMIT) & ~self._known(own)

    def split(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The set's shingles of the first class, and as many of the others as its prefix needs beyond them."""
        known = self._known(own)
        plain = own[~known]
        at = int(np.searchsorted(plain, _LIMIT))
        later = plain[at:]
        lacking = max(0, prefix_length(len(own)) - at)
        if lacking > len(later) and known.any():
            hot = own[known]
            later = np.append(later, hot[np.lexsort((hot, self.counts[np.searchsorted(self.hot, hot)]))])
        return plain[:at], later[:lacking]


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    return (v.as_buffer().to_pybytes() if v.is_valid else None for v in column)


def _mark() -> Column:
    """128 bits of doc_id and text."""
    said = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.when(F.col("text").isNull(), "-").otherwise(":"), F.coalesce("text", F.lit("")))
    return F.unhex(F.md5(said))


def _identity(own: np.ndarray) -> tuple[int, int]:
    high, low = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64)
    return int(high), int(low)


def _order(docs: DataFrame) -> Order:
    every = max(1, -(-docs.count() // SAMPLE))

    def said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t) for t in _texts(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({"low": [_identity(s)[1] for s in sets], "own": sets}, pa.schema([("low", pa.int64()), ("own", pa.list_(pa.int64()))]))

    sampled = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0).select("text")
    sets = sampled.mapInArrow(said, "low long, own array<long>").groupBy("low").agg(F.first("own").alias("own"))
    counts = sets.select(F.explode("own").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= HOT)
    found = counts.orderBy(F.desc("n"), "token").limit(HOTTEST).orderBy("token").toArrow()
    return Order(found["token"].to_numpy(), found["n"].to_numpy())


def _marked(docs: DataFrame, order: Order) -> DataFrame:
    """(mark, doc_id, high, low, n, counted, parity, fp) of every row: its set's identity, size, shingles of the first class and fingerprint."""
    shared = shipped(docs.sparkSession, order, "the hot shingles")
    rows = docs.select(_mark().alias("mark"), "doc_id", "text")

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            made = []
            for text in _texts(batch.column("text")):
                runs = run_hashes(text, SHINGLE)
                own = np.unique(runs.view(np.int64))
                made.append((*_identity(own), len(own), int(order.counted(own).sum()), parities(own), simhash.majority(runs)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*made) if made else [[]] * 6, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("mark"), batch.column("doc_id"), *columns], ["mark", "doc_id", "high", "low", "n", "counted", "parity", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(known, f"mark binary, doc_id {kind}, high long, low long, n long, counted long, parity binary, fp long")


def _batched(parts: Iterator[dict[str, np.ndarray]], schema: pa.Schema, rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[schema.names[0]])
        if size >= rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[f.name] for p in held]), f.type) for f in schema], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[f.name] for p in held]), f.type) for f in schema], schema=schema)


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of sorted batches, cut only between keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        at = int(np.searchsorted(keys, keys[-1]))
        if held and (at or held[-1].column(key)[-1].as_py() != keys[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = []
        elif at:
            yield pa.Table.from_batches([batch.slice(0, at)])
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _starts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def _shared(docs: DataFrame, order: Order, collided: list[int]) -> DataFrame:
    """(id, token, freq) of every shingle that may be in a prefix and that several sets have: in how many, up to MANY.

    A task sends a set's shingles once, however many copies it sees. A shingle's rows are at most one for each set and pass
    through a task in a stream.
    """
    shared = shipped(docs.sparkSession, (order, set(collided)), "the hot shingles")

    def said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, twice = shared.value
        seen: set[int] = set()

        def parts() -> Iterator[dict[str, np.ndarray]]:
            for batch in batches:
                for text in _texts(batch.column("text")):
                    own = shingle_set(text)
                    high, low = _identity(own)
                    name = high if low in twice else low
                    if len(own) and name not in seen:
                        seen.add(name)
                        tokens = np.concatenate(order.split(own))
                        yield {"token": tokens, "id": np.full(len(tokens), name)}

        return _batched(parts(), pa.schema([("token", pa.int64()), ("id", pa.int64())]))

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[dict[str, np.ndarray]]:
            token, own = np.zeros(0, np.int64), np.zeros(0, np.int64)
            passing = last = None  # the shingle that has MANY sets already, and its last set
            for batch in batches:
                new, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "id"))
                if passing is not None and len(new):
                    n = int(np.searchsorted(new, passing, side="right"))
                    fresh = ids[:n][np.append(ids[:1] != last, ids[1:n] != ids[: n - 1])] if n else ids[:0]
                    if n:
                        last = ids[n - 1]
                        yield {"id": fresh, "token": np.full(len(fresh), passing), "freq": np.full(len(fresh), MANY)}
                    if n == len(new):
                        continue
                    new, ids, passing = new[n:], ids[n:], None
                token, own = np.concatenate([token, new]), np.concatenate([own, ids])
                once = np.append(True, (token[1:] != token[:-1]) | (own[1:] != own[:-1])) if len(token) else np.zeros(0, bool)
                token, own = token[once], own[once]
                if not len(token):
                    continue
                at = int(np.searchsorted(token, token[-1]))
                yield counted(token[:at], own[:at])
                token, own = token[at:], own[at:]
                if len(token) >= MANY:
                    passing, last = int(token[-1]), own[-1]
                    yield counted(token, own)
                    token, own = token[:0], own[:0]
            yield counted(token, own)

        def counted(token: np.ndarray, own: np.ndarray) -> dict[str, np.ndarray]:
            starts = _starts(token)
            freq = np.repeat(np.diff(np.append(starts, len(token))), np.diff(np.append(starts, len(token))))
            more = freq > 1
            return {"id": own[more], "token": token[more], "freq": np.minimum(freq[more], MANY)}

        return _batched(parts(), pa.schema([("id", pa.int64()), ("token", pa.int64()), ("freq", pa.int64())]))

    rows = docs.select("text").mapInArrow(said, "token long, id long")
    return rows.repartition("token").sortWithinPartitions("token", "id").mapInArrow(several, "id long, token long, freq long")


def _prefixes(shared: DataFrame, sets: DataFrame, order: Order) -> DataFrame:
    """(token, id, n, place, parity): the shingles of each set's prefix that several sets have, and how many come before it.

    A shingle that no other set has comes first; of those beyond the first class the place is a lower bound.
    """
    hot = shipped(sets.sparkSession, order, "the hot shingles")
    empty = lambda name, kind: F.lit(None).cast(kind).alias(name)
    about = sets.select("id", empty("token", "long"), F.lit(0).cast("long").alias("freq"), "n", "counted", "parity")
    both = about.unionByName(shared.select("id", "token", "freq", empty("n", "long"), empty("counted", "long"), empty("parity", "binary")))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = hot.value
        for rows in _runs(batches, "id"):
            freq = rows["freq"].to_numpy()
            first = np.flatnonzero(freq == 0)
            owner = np.cumsum(freq == 0) - 1
            n, m = (rows[c].take(pa.array(first)).to_numpy().astype(np.int64) for c in ("n", "counted"))
            token = rows["token"].to_numpy()
            token = np.where(freq == 0, 0, token).astype(np.int64)
            early = (freq > 0) & order.counted(token)
            common = np.bincount(owner[early], minlength=len(first))
            before = np.cumsum(early) - early
            rank = before - before[first][owner]
            alone = m - common
            place = np.where(early, alone[owner] + rank, m[owner])
            keeps = np.flatnonzero((freq > 0) & (place < prefix_length(n)[owner]))
            own = owner[keeps]
            parity = rows["parity"].take(pa.array(first[own])).combine_chunks()
            found = [pa.array(token[keeps]), rows["id"].take(pa.array(keeps)).combine_chunks(), pa.array(n[own]), pa.array(place[keeps]), parity]
            yield pa.RecordBatch.from_arrays(found, ["token", "id", "n", "place", "parity"])

    return both.repartition("id").sortWithinPartitions("id", "freq", "token").mapInArrow(chosen, "token long, id long, n long, place long, parity binary")


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows by bucket: a shingle's rows, or two tiles of them where they are more than TILE."""
    heavy = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n_sets")).filter(F.col("n_sets") > TILE)
    heavy = heavy.select("token", F.ceil(F.col("n_sets") / TILE).alias("tiles"))
    tiles = rows.join(heavy, "token", "left").withColumn("own", F.pmod(F.xxhash64("id"), F.col("tiles")))
    other = F.when(F.col("tiles").isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    each = tiles.withColumn("other", F.explode(other))
    bucket = F.when(F.col("tiles").isNull(), F.col("token")).otherwise(F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")))
    return each.select(bucket.alias("bucket"), "id", "n", "place", "parity")


def _partners(ids: np.ndarray, label: np.ndarray, n: np.ndarray, place: np.ndarray, parity: np.ndarray, tested: list, offers: int) -> list[list[int]]:
    """For each set of a bucket its first partners, at most `offers`, of another label, not tested, that may be similar."""
    found: list[list[int]] = [[] for _ in ids]
    live = np.arange(len(ids)) if (label != label[0]).any() else np.zeros(0, np.int64)
    width = 256
    for at in range(0, len(ids), width):
        if not len(live):
            break
        part = slice(at, at + width)
        a, b = n[live, None], n[None, part]
        left = np.minimum((n - place)[live, None], (n - place)[None, part])  # shared, if this is the first shingle that they share
        fits = (label[live, None] != label[None, part]) & (OF * np.minimum(a, b) >= LEAST * np.maximum(a, b)) & ((LEAST + OF) * left >= LEAST * (a + b))
        i, j = np.nonzero(fits)
        for k in range(0, len(i), 1 << 16):
            x, y = live[i[k : k + (1 << 16)]], at + j[k : k + (1 << 16)]
            away = np.bitwise_count(parity[x] ^ parity[y]).sum(axis=1, dtype=np.int64)
            near = (LEAST + OF) * away <= (OF - LEAST) * (n[x] + n[y])
            for u, v in zip(x[near].tolist(), y[near].tolist()):
                if len(found[u]) < offers and not (tested[u] and ids[v] in tested[u]):
                    found[u].append(int(ids[v]))
        live = live[[len(found[u]) < offers for u in live]]
    return found


def _offered(rows: DataFrame, offers: int) -> DataFrame:
    """The open rows with the `partners` that a set offers in their bucket. Rows are (bucket, id, n, place, parity, label, tested)."""
    out = pa.schema([("bucket", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("place", pa.int64()), ("parity", pa.binary()), ("partners", pa.list_(pa.int64()))])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _runs(batches, "bucket"):
            bucket = held["bucket"].to_numpy()
            starts = _starts(bucket)
            ends = np.append(starts[1:], len(bucket))
            several = np.flatnonzero(ends - starts > 1)
            if not len(several):
                continue
            ids, label, n, place = (held[c].to_numpy() for c in ("id", "label", "n", "place"))
            parity = np.frombuffer(b"".join(held["parity"].to_pylist()), np.uint64).reshape(len(bucket), PLACES // 64)
            tested = [set(t) if t else None for t in held["tested"].to_pylist()]
            keeps, partners = [], []
            for a, b in zip(starts[several], ends[several]):
                for k, p in enumerate(_partners(ids[a:b], label[a:b], n[a:b], place[a:b], parity[a:b], tested[a:b], offers)):
                    if p:
                        keeps.append(a + k)
                        partners.append(p)
            open_rows = held.select(["bucket", "id", "n", "place", "parity"]).take(pa.array(keeps, pa.int64())).append_column("partners", pa.array(partners, pa.list_(pa.int64())))
            yield from open_rows.cast(out).to_batches()

    return rows.repartition("bucket").sortWithinPartitions("bucket", "id").mapInArrow(met, "bucket long, id long, n long, place long, parity binary, partners array<long>")


def _pairs(found: DataFrame, offers: int) -> DataFrame:
    """(u, v) of each set's first partners over all its buckets."""
    each = found.select("id", F.explode("partners").alias("other")).distinct()
    first = each.groupBy("id").agg(F.slice(F.array_sort(F.collect_list("other")), 1, offers).alias("others"))
    return first.select("id", F.explode("others").alias("other")).select(F.least("id", "other").alias("u"), F.greatest("id", "other").alias("v")).distinct()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) and whether they are similar. A set of many pairs is dealt over tasks."""
    many = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / F.lit(SPREAD)).alias("parts"))
    own = many.join(texts.select(F.col("id").alias("u"), F.col("text").alias("text_u")), "u")
    own = own.select("u", "text_u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    dealt = pairs.join(many, "u").select("u", "v", F.pmod(F.xxhash64("v"), F.col("parts")).alias("part"))
    both = dealt.join(texts.select(F.col("id").alias("v"), F.col("text").alias("text_v")), "v").join(own, ["u", "part"])

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            found = []
            for key, a, b in zip(batch.column("u").to_pylist(), _texts(batch.column("text_u")), _texts(batch.column("text_v"))):
                if key != last:
                    last, known = key, shingle_set(a)
                found.append(similar(known, shingle_set(b)))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(found, pa.bool_())], ["u", "v", "alike"])

    return stored(both.select("u", "v", "text_u", "text_v").mapInArrow(checked, "u long, v long, alike boolean"))


def _proposed(open_sets: DataFrame) -> DataFrame:
    """(u, v) by SimHash: sets of one fingerprint with the least of them, and of each fingerprint the least one with that of the least linked one."""
    least = open_sets.groupBy("fp").agg(F.min("id").alias("least"))
    equal = open_sets.join(least, "fp").filter("id != least").select(F.col("least").alias("u"), F.col("id").alias("v"))
    linked = simhash.links(open_sets.select("fp").distinct())
    for end in ("u", "v"):
        linked = linked.join(least.select(F.col("fp").alias(end), F.col("least").alias(f"id_{end}")), end)
    first = linked.groupBy(F.greatest("id_u", "id_v").alias("v")).agg(F.min(F.least("id_u", "id_v")).alias("u"))
    return equal.unionByName(first.filter("u != v").select("u", "v"))


def _wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text) of the rows whose marks are wanted (mark, id).

    A bit filter of bounded size, broadcast, keeps most other texts out of the shuffle; what it lets through is joined.
    """
    bit = F.pmod(F.xxhash64("mark"), F.lit(FILTER_BITS))
    word = F.floor(bit / 64).cast("long")
    words = wanted.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))).alias("bits")).toArrow()  # FILTER_BITS / 64 rows at most
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = shipped(docs.sparkSession, held, "the filter")

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value.view(np.uint64)
        for batch in batches:
            at = batch.column("bit").to_numpy(zero_copy_only=False)
            keeps = (bits[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1
            yield batch.select(["mark", "text"]).filter(pa.array(keeps))

    rows = docs.select(_mark().alias("mark"), "text").withColumn("bit", bit).mapInArrow(passing, "mark binary, text string")
    return stored(rows.join(wanted, "mark").groupBy("id").agg(F.first("text").alias("text")))


def groups(docs: DataFrame, sets: DataFrame, order: Order, collided: list[int]) -> DataFrame:
    """(node, root) of every set that is similar to another: the least id reachable."""
    rows = _dealt(stored(_prefixes(_shared(docs, order, collided), sets, order)))
    offers = 1
    found = stored(_offered(rows.select("*", F.col("id").alias("label"), F.array().cast("array<long>").alias("tested")), offers))
    open_sets = stored(sets.join(found.select("id").distinct(), "id", "left_semi").select("id", "fp", "mark"))
    texts = _wanted_texts(docs, open_sets.select("mark", "id"))
    checked = _verified(_proposed(open_sets).unionByName(_pairs(found, offers)).distinct(), texts)
    while True:
        label = stored(components(checked.filter("alike").select("u", "v"), by_rows=True))
        rooted = label.select(F.col("node").alias("id"), "root", F.lit(None).cast("long").alias("other"))
        failed = checked.filter("NOT alike").select(F.lit(None).cast("long").alias("root"), F.explode(F.array(F.struct(F.col("u").alias("id"), F.col("v").alias("other")), F.struct(F.col("v").alias("id"), F.col("u").alias("other")))).alias("one"))
        about = rooted.unionByName(failed.select("one.id", "root", "one.other")).groupBy("id").agg(F.max("root").alias("root"), F.collect_list("other").alias("tested"))
        rows = found.drop("partners").join(about, "id", "left").select("bucket", "id", "n", "place", "parity", F.coalesce("root", "id").alias("label"), "tested")
        offers = min(4 * offers, OFFERS)
        after = stored(_offered(rows, offers))
        discard(found)
        found = after
        if found.isEmpty():
            discard(texts, found, open_sets)
            return label
        newly, before = _verified(_pairs(found, offers), texts), checked
        checked = stored(before.unionByName(newly))
        discard(before, newly, label)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each group, unchanged: that of the smallest doc_id (of equal ones, any one row)."""
    order = _order(docs)
    marks = stored(_marked(docs, order))
    twice = marks.groupBy("low").agg(F.min("high").alias("a"), F.max("high").alias("b")).filter("a != b").select("low").limit(10_001).collect()
    if len(twice) > 10_000:  # sets whose 64 bits collide: expected are some forty among 4e10 sets
        raise ValueError("too many sets share 64 bits of their hashes")
    collided = [r["low"] for r in twice]
    name = F.when(F.col("low").isin(collided), F.col("high")).otherwise(F.col("low")) if collided else F.col("low")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    same = marks.withColumn("id", name).groupBy("id")
    sets = stored(same.agg(F.min(rank).alias("least"), *(F.first(c).alias(c) for c in ("n", "counted", "parity", "fp"))).withColumn("mark", F.col("least.mark")))
    rooted = groups(docs, sets, order, collided).withColumnRenamed("node", "id")
    stays = sets.select("id", "least").join(rooted, "id", "left").groupBy(F.coalesce("root", "id").alias("root")).agg(F.min("least").alias("least"))
    kept = stored(stays.select(F.col("least.mark").alias("mark")))
    discard(marks, sets)
    rows = packed(docs, mark=_mark())
    return rows.join(kept, "mark").dropDuplicates(["mark"]).select("doc.*")
