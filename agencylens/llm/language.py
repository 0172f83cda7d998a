"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word is the sum over
all ways to cut it into pieces, by the forward algorithm; a text's is the product over its words, and the score is the
language's posterior under equal priors. Piece probabilities are learned by expectation maximisation (forward-backward)
from the word counts of at most `ROWS_PER_LANGUAGE` documents of each language and `SAMPLE_ROWS` in all, those with the
smallest hash of their id. Words are runs of letters, lower-cased, behind a word mark. Scoring streams over all documents,
once for every group of languages whose tables take `TABLE_BYTES`; the best language and the sum of all likelihoods go along.

Rows that share a doc_id and a language count once in training, with the least of their texts, and are scored row by row.
Very long texts are scored whole. Ties go to the first language by name. Original columns travel in one struct, so no name
clashes. A text that is null or has no letter, and any text if nothing could be learned, is `und` with score 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from agencylens.llm.shared import discard, held_out, packed, shipped, stored

#: Where the vocabulary lies, and the bounds of the training sample.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROWS_PER_LANGUAGE, SAMPLE_ROWS = 1024, 1 << 14
#: Hash bins that a language's ids are ranked in before they are ranked as a whole.
BINS = 64
#: Bytes of piece tables that one pass over the documents brings along.
TABLE_BYTES = 32 << 20
ROUNDS = 3
#: Count added to every piece; probability of a single character that is no piece, in any language.
SMOOTH, UNKNOWN = 0.02, 1e-7
MARK = "▁"
#: Logarithms of words that a task remembers, a number for each language.
REMEMBERED = 2_400_000
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")


def pieces(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's pieces of lower-case letters, with or without the word mark, sorted."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in every if p == MARK or (p.removeprefix(MARK).isalpha() and p == p.lower())})


def words_of(text: str | None) -> list[str]:
    return [MARK + w for w in _WORD.findall(text.lower())] if text else []


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


class Lattice:
    """All segmentations of words: a vocabulary and its longest piece. Piece len(vocabulary) is a single unknown character, the next is none."""

    def __init__(self, vocabulary: list[str]) -> None:
        self.number = {p: i for i, p in enumerate(vocabulary)}
        self.unknown, self.none = len(vocabulary), len(vocabulary) + 1
        self.longest = max(map(len, vocabulary), default=1)

    def arcs(self, words: list[str]) -> np.ndarray:
        """(word, end, length - 1): the piece of that length that ends there, of words of equal length."""
        n, longest = len(words[0]), min(self.longest, len(words[0]))
        get, none, out = self.number.get, self.none, np.full((len(words), n, longest), self.none, np.int32)
        for k in range(longest):
            found = [get(w[at : at + k + 1], none) for w in words for at in range(n - k)]
            out[:, k:, k] = np.array(found, np.int32).reshape(len(words), n - k)
        alone = out[:, :, 0]
        alone[alone == none] = self.unknown
        return out

    def forward(self, arcs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """table: (piece, language) probabilities. Returns scaled sums (word, place, language) and the logarithms of the scales."""
        n_words, n, longest = arcs.shape
        alpha, scale = np.zeros((n_words, n + 1, table.shape[1])), np.zeros((n_words, n + 1, table.shape[1]))
        alpha[:, 0] = 1.0
        for end in range(n):
            span = min(longest, end + 1)
            back = np.exp(scale[:, end + 1 - span : end + 1] - scale[:, end : end + 1]) * alpha[:, end + 1 - span : end + 1]
            total = np.einsum("wkl,wkl->wl", back, table[arcs[:, end, :span][:, ::-1]])
            alpha[:, end + 1] = 1.0
            scale[:, end + 1] = scale[:, end] + np.log(total)
        return alpha, scale

    def log_probability(self, words: list[str], table: np.ndarray) -> np.ndarray:
        """(word, language): logarithm of the sum over all segmentations."""
        out = np.zeros((len(words), table.shape[1]))
        for rows in _by_length(words, 160_000 // max(8, table.shape[1])):
            own = [words[i] for i in rows]
            out[rows] = self.forward(self.arcs(own), table)[1][:, -1]
        return out

    def expected(self, words: list[str], counts: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Expected number of each piece over all segmentations of the counted words, for one language."""
        total = np.zeros(len(table))
        for rows in _by_length(words):
            arcs = self.arcs([words[i] for i in rows])
            n = arcs.shape[1]
            ahead = self.forward(arcs, table)[1][:, :, 0]
            behind = np.full((len(rows), n + 1), -np.inf)
            behind[:, n] = 0.0
            for start in range(n - 1, -1, -1):
                terms = [np.log(np.maximum(table[arcs[:, start + k, k], 0], 1e-300)) + behind[:, start + k + 1] for k in range(min(arcs.shape[2], n - start))]
                behind[:, start] = np.logaddexp.reduce(terms, axis=0)
            for end in range(n):
                for k in range(min(arcs.shape[2], end + 1)):
                    p = table[arcs[:, end, k], 0]
                    share = np.exp(ahead[:, end - k] + behind[:, end + 1] - ahead[:, n]) * p * counts[rows]
                    np.add.at(total, arcs[:, end, k], share)
        return total


def _by_length(words: list[str], most: int = 20_000) -> Iterator[np.ndarray]:
    """Positions of words of equal length, in parts whose lattices stay small."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        step = max(1, most * 10 // int(n))
        for at in range(0, len(rows), step):
            yield rows[at : at + step]


def learned(lattice: Lattice, words: list[str], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language, with the unknown character and none behind."""
    size = lattice.unknown
    probability = np.full(size, 1.0 / size)
    for _ in range(rounds):
        table = np.append(probability, [UNKNOWN, 0.0])[:, None]
        mass = lattice.expected(words, counts, table)[:size] + SMOOTH
        probability = mass / mass.sum()
    return np.append(probability, [UNKNOWN, 0.0])


def sampled(docs: DataFrame) -> DataFrame:
    """Columns id and language of the training sample, at most `SAMPLE_ROWS` rows.

    Ids are ranked within (language, bin of their hash), then what is left of each bin within the language.
    """
    id_hash = F.xxhash64("id")
    known = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), F.col("lang").alias("language")).distinct()
    first = lambda *keys: F.row_number().over(Window.partitionBy("language", *keys).orderBy(id_hash, "id"))
    low = known.withColumn("bin", F.pmod(id_hash, F.lit(BINS))).withColumn("turn", first("bin")).filter(F.col("turn") <= ROWS_PER_LANGUAGE)
    own = low.withColumn("turn", first()).filter(F.col("turn") <= ROWS_PER_LANGUAGE)
    return own.orderBy("turn", "language").limit(SAMPLE_ROWS).select("id", "language")


def fit(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Columns language and table, its piece probabilities.

    The sample's ids are broadcast, `SAMPLE_ROWS` at most; the words of one language's sample meet in one task, counted.
    """
    sample = sampled(docs)
    rows = docs.select("doc_id", "lang", "text").join(F.broadcast(sample), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("language")))
    texts = rows.groupBy("id", "language").agg(F.min("text").alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            for text, language in zip(batch.column("text"), batch.column("language"), strict=True):
                for word in words_of(text.as_py()):
                    key = language.as_py(), word
                    counts[key] = counts.get(key, 0) + 1
            arrays = [pa.array([k[i] for k in counts], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(list(counts.values()), pa.int64())], ["language", "word", "n"])

    shared = shipped(docs.sparkSession, vocabulary, "the vocabulary")

    def maximised(pdf: pd.DataFrame) -> pd.DataFrame:
        lattice = Lattice(shared.value)
        pdf = pdf.sort_values("word")
        table = learned(lattice, pdf["word"].tolist(), pdf["n"].to_numpy(float))
        return pd.DataFrame({"language": [pdf["language"].iloc[0]], "table": [table.tolist()]})

    words = texts.mapInArrow(counted, "language string, word string, n long").groupBy("language", "word").agg(F.sum("n").alias("n"))
    return words.groupBy("language").applyInPandas(maximised, "language string, table array<double>")


class _Remembered:
    """Logarithms of words under some languages, computed once a task while there is room."""

    def __init__(self, vocabulary: list[str], table: np.ndarray) -> None:
        self.lattice, self.table = Lattice(vocabulary), table
        self.most = max(1, REMEMBERED // table.shape[1])
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.logs = np.zeros((0, self.table.shape[1]))

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.place) > self.most:
            self.forget()
        fresh = list(dict.fromkeys(w for own in texts for w in own if w not in self.place))
        if fresh:
            self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh)), strict=True))
            self.logs = np.concatenate([self.logs, self.lattice.log_probability(fresh, self.table)])

    def of(self, words: list[str]) -> np.ndarray:
        return self.logs[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(axis=0)


def _compared(rows: DataFrame, vocabulary: list[str], languages: list[str], table: np.ndarray) -> DataFrame:
    """The rows with the best of these and all former languages, its logarithm and that of the sum over languages."""
    shared = shipped(rows.sparkSession, (vocabulary, languages, table), "the piece tables")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, languages, table = shared.value
        known = _Remembered(vocabulary, table)
        for batch in batches:
            best, top, total = (batch.column(c).to_pylist() for c in ("best", "top", "total"))
            for at in range(0, batch.num_rows, 256):
                texts = batch.column("text").slice(at, 256).to_pylist()
                said = [words_of(t) for t in texts]
                known.learn(said)
                for i, (text, own) in enumerate(zip(texts, said, strict=True), at):
                    if not own or not has_letter(text):
                        continue
                    logs = known.of(own)
                    first = int(logs.argmax())
                    here = float(logs[first] + np.log(np.exp(logs - logs[first]).sum()))
                    total[i] = here if best[i] is None else float(np.logaddexp(total[i], here))
                    if best[i] is None or logs[first] > top[i]:
                        best[i], top[i] = languages[first], float(logs[first])
            columns = [batch.column("doc"), batch.column("text"), pa.array(best, pa.string()), pa.array(top, pa.float64()), pa.array(total, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "text", "best", "top", "total"])

    return rows.mapInArrow(compare, rows.schema)


def identified(docs: DataFrame, keep: list[str] | None = None, vocabulary: str = VOCABULARY, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Struct `doc` of the kept columns, `lang_pred` and `score` of every whole text.

    The tables are written to the shared folder, a row for each language. Where they take more than `table_bytes`, the
    documents are passed once for each group of languages, with what is known so far written in between.
    """
    known = pieces(vocabulary)
    tables = stored(fit(docs, known))
    names = sorted(r["language"] for r in tables.select("language").collect())  # SAMPLE_ROWS at most
    most = max(1, table_bytes // (8 * (len(known) + 2)))
    nothing = {"best": F.lit(None).cast("string"), "top": F.lit(None).cast("double"), "total": F.lit(None).cast("double")}
    rows, former = packed(docs, keep, text=F.col("text"), **nothing), None
    for at in range(0, len(names), most):
        if at:
            rows = stored(rows)
            if former is not None:
                discard(former)
            former = rows
        group = names[at : at + most]
        own = {r["language"]: r["table"] for r in tables.filter(F.col("language").isin(group)).collect()}  # table_bytes
        rows = _compared(rows, known, group, np.array([own[name] for name in group]).T)
    return rows.select("doc", F.coalesce("best", F.lit(UNDETERMINED)).alias("lang_pred"), F.coalesce(F.exp(F.col("top") - F.col("total")), F.lit(0.0)).alias("score"))


def language_report(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, held_out, lang_pred, score."""
    doc_id = F.col("doc.doc_id")
    return identified(docs, keep=["doc_id"]).select(doc_id, held_out(doc_id).alias("held_out"), "lang_pred", "score")
