"""Languages of a text as a mixture of learned n-gram models.

Each word is taken to come from one language; its likelihood there is the product of the smoothed
conditional probabilities of its letters given the two before them. Expectation-maximisation finds
the proportions of the languages in a document, once for every nested set of the most likely ones,
and the set with the best penalised likelihood is kept. n-grams are counted over the whole training
table by Spark, in a fixed number of hashed cells, so the model has one size whatever the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomframe.llm.common import MEMO_ENTRIES, slices

#: Cells for hashed n-grams and for the contexts they follow.
CELLS = 1 << 16
#: Rounds of expectation-maximisation per language set.
ROUNDS = 12
#: Added to each count.
SMOOTH = 0.5
NO_LANGUAGE = "und"

_ONE, _TWO, _THREE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _cells(a: np.ndarray, b: np.ndarray, c: np.ndarray | None) -> np.ndarray:
    mixed = a * _ONE + b * _TWO + (c * _THREE if c is not None else np.uint64(7))
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _ONE) >> np.uint64(48)).astype(np.int32) % CELLS


def word_cells(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all letter trigrams of some words, bounded by blanks: the word, the cell, and its context's cell.

    Only letters count, in lower case; a word without a letter has none.
    """
    text = (b" ".join(words) + b" ").decode().lower()
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    seen, place = np.unique(codes, return_inverse=True)
    codes = codes[np.array([c == 32 or chr(c).isalpha() for c in seen.tolist()])[place]]
    one = np.concatenate([[np.uint64(32)], codes[:-1]])
    two = np.where(one == 32, np.uint64(32), np.concatenate([[np.uint64(32)] * 2, codes[:-2]])[: len(codes)])
    word = np.cumsum(codes == 32) - (codes == 32)
    used = (codes != 32) | (one != 32)
    codes, one, two = codes[used], one[used], two[used]
    return word[used], _cells(two, one, codes), _cells(two, one, None)


@dataclass(frozen=True)
class LanguageModel:
    """Log-probabilities of n-gram cells (cells x languages) and the language names in their order."""

    languages: list[str]
    trigrams: np.ndarray
    contexts: np.ndarray

    @staticmethod
    def from_counts(languages: list[str], trigrams: np.ndarray, contexts: np.ndarray) -> LanguageModel:
        return LanguageModel(
            languages, np.log(trigrams + SMOOTH).astype(np.float32), np.log(contexts + SMOOTH * 40).astype(np.float32)
        )

    def words(self, words: list[bytes]) -> np.ndarray:
        """A row of log-likelihoods per word; not a number for words without a letter."""
        word, grams, contexts = word_cells(words)
        each = self.trigrams[grams] - self.contexts[contexts]
        total = np.column_stack([np.bincount(word, each[:, k], len(words)) for k in range(len(self.languages))]).astype(float)
        total[np.bincount(word, minlength=len(words)) == 0] = np.nan
        return total


class WordRows:
    """Rows of a word table, worked out for all new words of a slice at once and kept while there is room."""

    def __init__(self, compute, entries: int = 4 * MEMO_ENTRIES):
        self.compute, self.entries = compute, entries
        self.place: dict[bytes, int] = {}
        self.table: np.ndarray | None = None
        self.filled = 0

    def rows(self, words: list[bytes]) -> np.ndarray:
        """The row of each word; valid until the next call."""
        if len(self.place) >= self.entries:
            self.place.clear()
            self.filled = 0
        new = [w for w in set(words) if w not in self.place]
        if new:
            block = self.compute(new)
            end = self.filled + len(new)
            if self.table is None or end > len(self.table):
                grown = np.empty((2 * end, block.shape[1]), block.dtype)
                if self.filled:
                    grown[: self.filled] = self.table[: self.filled]
                self.table = grown
            self.table[self.filled : end] = block
            self.place.update(zip(new, range(self.filled, end)))
            self.filled = end
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))


def learn(df: DataFrame, text: str = "text", lang: str = "lang", where: Column | None = None) -> LanguageModel:
    """Count the n-grams of every whole text with a language and give the model.

    Rows whose text or language is null are left out; repeated rows count each time. Python tasks add
    up their own part and Spark adds the parts by cell, so what reaches the driver is at most
    ``2 * CELLS`` rows per language, whatever the corpus. No usable row: a model without languages.
    """
    rows = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = (rows.where(where) if where is not None else rows).select(F.col(text).alias("__text"), F.col(lang).alias("__lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches, "__text"):
            words: dict[str, Counter] = {}
            for value, of in zip(batch.column("__text").to_pylist(), batch.column("__lang").to_pylist()):
                words.setdefault(of, Counter()).update(value.encode().split())
            for of, found in words.items():
                word, grams, contexts = word_cells(list(found))
                often = np.fromiter(found.values(), np.float64, len(found))[word]
                add = np.concatenate([np.bincount(grams, often, CELLS), np.bincount(contexts, often, CELLS)]).astype(np.int64)
                totals[of] = totals[of] + add if of in totals else add
        for of, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([of] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(total[used])],
                ["lang", "cell", "n"],
            )

    counted = rows.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = counted.toPandas()
    languages = sorted(found["lang"].unique().tolist())
    table = np.zeros((2 * CELLS, len(languages)))
    table[found["cell"].to_numpy(), found["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=int)] = found["n"]
    return LanguageModel.from_counts(languages, table[:CELLS], table[CELLS:])


def mixtures(logs: np.ndarray, counts: np.ndarray, starts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Proportions of the languages per document.

    ``logs`` has a row per (document, distinct word), ``counts`` how often it occurs there, and
    ``starts`` the first row of each document; every document has a row.
    """
    docs, languages = len(starts), logs.shape[1]
    doc_of = np.repeat(np.arange(docs), np.diff([*starts, len(logs)]))
    logs = np.ascontiguousarray(logs.T)  # a row per language: sums over languages add whole rows
    top = logs.max(0)
    likely = np.exp(logs - top)
    total = np.add.reduceat(counts, starts)
    penalty = 0.5 * np.log(np.maximum(total, 2))

    def fit(member: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        share = member / member.sum(0)
        for _ in range(rounds):
            joint = likely * share[:, doc_of]
            joint *= counts / np.maximum(joint.sum(0), 1e-300)
            share = np.add.reduceat(joint, starts, axis=1) / total
        mixed = (likely * share[:, doc_of]).sum(0)
        return share, np.add.reduceat(counts * (np.log(np.maximum(mixed, 1e-300)) + top), starts)

    best, score = fit(np.ones((languages, docs)), rounds)
    score = score - (languages - 1) * penalty
    rank = np.argsort(np.argsort(-best, axis=0, kind="stable"), axis=0)
    for size in range(1, languages):
        share, fitted = fit((rank < size).astype(float), rounds if size > 1 else 0)  # one language has all
        fitted = fitted - (size - 1) * penalty
        better = fitted >= score
        best, score = np.where(better, share, best), np.where(better, fitted, score)
    return best.T


def predict(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (its proportion) and ``proportions`` (by language, zeros left out).

    A null text, one without a letter, and any text under a model without languages is ``und`` with
    score 0 and no proportions. Ties go to the language first in order. Only the text is looked at;
    existing columns of these names are replaced. Memory per task: one slice of texts and the model,
    whose size is fixed and which is broadcast.
    """
    df = df.drop("lang_pred", "score", "proportions")
    schema = (
        T.StructType([*df.schema.fields]).add("lang_pred", T.StringType()).add("score", T.DoubleType())
        .add("proportions", T.MapType(T.StringType(), T.DoubleType()))
    )
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.trigrams, model.contexts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(*shared.value)
        table = WordRows(known.words)
        for batch in slices(batches, text):
            shares = np.zeros((batch.num_rows, len(known.languages)))
            texts = [(value or "").encode().split() for value in batch.column(text).to_pylist()]
            found = table.rows([w for words in texts for w in words]) if known.languages else np.empty(0, np.int64)
            pairs = np.repeat(np.arange(len(texts)), [len(w) for w in texts])[: len(found)] * (table.filled + 1) + found
            pairs, counts = np.unique(pairs, return_counts=True)
            doc, word = np.divmod(pairs, table.filled + 1)
            logs = table.table[word] if len(word) else np.empty((0, 1))
            spoken = ~np.isnan(logs[:, 0])
            rows, starts = np.unique(doc[spoken], return_index=True)
            if len(rows):
                shares[rows] = mixtures(logs[spoken], counts[spoken].astype(float), starts)
            best = shares.argmax(1) if known.languages else np.zeros(batch.num_rows, int)
            has = np.zeros(batch.num_rows, bool)
            has[rows] = True
            names = [known.languages[b] if h else NO_LANGUAGE for b, h in zip(best, has)]
            scores = [min(1.0, float(shares[i, b])) if h else 0.0 for i, (b, h) in enumerate(zip(best, has))]
            mixed = [[(n, float(x)) for n, x in zip(known.languages, row) if x > 1e-6] for row in shares]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(mixed, pa.map_(pa.string(), pa.float64()))],
                schema.names,
            )

    return df.mapInArrow(run, schema)
