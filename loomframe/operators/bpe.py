"""Byte-pair encoding with a vocabulary the user supplies.

Text is cut into pieces by an expression. A batch merges each of its distinct pieces once, and a
worker remembers the pieces it has met, so documents are encoded where they are, in one pass and
without a shuffle.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomframe.operators.tokens import ArrayCarrier, sliced_udf

# Fixed value: the public pre-tokenizer pattern of the byte-pair vocabularies this reads
PIECE_PATTERN = r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_VOCABULARY = 500_000
# Pieces a worker remembers before it starts anew, and the longest it remembers
REMEMBERED = 200_000
REMEMBERED_CHARS = 64


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes to rank; merges of lower rank come first. ``end`` is the end-of-text id."""

    ranks: dict[bytes, int]
    end: int

    def __post_init__(self) -> None:
        if len(self.ranks) > MAX_VOCABULARY:
            raise ValueError(f"vocabulary of {len(self.ranks)} entries is too large to ship to every task")

    @classmethod
    def from_merges(cls, merges: list[bytes]) -> Vocabulary:
        """All single bytes, then the merged tokens in order."""
        tokens = [bytes([b]) for b in range(256)] + merges
        return cls({t: i for i, t in enumerate(tokens)}, len(tokens))

    @classmethod
    def from_file(cls, spark: SparkSession, path: str) -> Vocabulary:
        """Lines of base64 token and rank."""
        lines = spark.read.text(path).where(F.length("value") > 0).limit(MAX_VOCABULARY + 1).collect()
        pairs = [row.value.split() for row in lines]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        return cls(ranks, max(ranks.values()) + 1)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the neighbouring pair of lowest rank, leftmost first, until no pair is in the vocabulary."""
    size = len(piece)
    after = list(range(1, size + 1))  # start of the next part
    before = list(range(-1, size - 1))
    pairs = [(ranks[p], i) for i in range(size - 1) if (p := piece[i : i + 2]) in ranks]
    heapify(pairs)
    while pairs:
        rank, i = heappop(pairs)
        j = after[i]
        if j is None or j >= size or ranks.get(piece[i : after[j]]) != rank:
            continue  # one of the two has been joined to something else
        end = after[i] = after[j]
        after[j] = None
        if end < size:
            before[end] = i
            if (p := piece[i : after[end]]) in ranks:
                heappush(pairs, (ranks[p], i))
        if (left := before[i]) >= 0 and (p := piece[left:end]) in ranks:
            heappush(pairs, (ranks[p], left))
    ids, i = [], 0
    while i < size:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE_PATTERN), 0)


def encoder(spark: SparkSession, vocabulary: Vocabulary) -> Callable[[Column], Column]:
    """Text column to token column, without a separator; null is empty."""
    ranks = spark.sparkContext.broadcast(vocabulary.ranks)
    met_before: dict[str, list[int]] = {}

    def ids_of(column: pa.Array) -> pa.Array:
        met = column.flatten().dictionary_encode()
        if len(met_before) > REMEMBERED:
            met_before.clear()
        ids = []
        for piece in met.dictionary.to_pylist():
            found = met_before.get(piece)
            if found is None:
                found = merge(piece.encode("utf-8"), ranks.value)
                if len(piece) <= REMEMBERED_CHARS:
                    met_before[piece] = found
            ids.append(found)
        spelled = pa.array(ids, pa.list_(pa.int32())).take(met.indices)
        return _regroup(column, spelled, spelled.flatten())

    udf = sliced_udf(ids_of, T.ArrayType(T.IntegerType()))
    return lambda text: udf(pieces(F.coalesce(text, F.lit(""))))


@dataclass(frozen=True)
class MergedCarrier(ArrayCarrier):
    """Byte-pair tokens wherever a carrier is asked for: segments are encoded one by one and joined."""

    encode: Callable[[Column], Column]
    spell: Callable[[str], list[int]]

    def from_text(self, text: Column) -> Column:
        return self.encode(text)

    def from_literal(self, text: str) -> Column:
        return F.array(*[F.lit(i) for i in self.spell(text)]).cast("array<int>")

    def text_count(self, text: Column) -> Column:
        return self.count(self.encode(text))


def carrier(spark: SparkSession, vocabulary: Vocabulary) -> MergedCarrier:
    def spell(text: str) -> list[int]:
        """Tokens of a marker, made once on the driver."""
        cut = spark.range(1).select(pieces(F.lit(text)).alias("p")).first().p
        return [i for piece in cut for i in merge(piece.encode("utf-8"), vocabulary.ranks)]

    return MergedCarrier(vocabulary.end, encoder(spark, vocabulary), spell)


def encode(docs: DataFrame, key: str, text: str, vocabulary: Vocabulary, ending: bool = True) -> DataFrame:
    """``key, tokens``, with the end-of-text token last unless ``ending`` is false."""
    tokens = encoder(docs.sparkSession, vocabulary)(F.col(text))
    return docs.select(key, (F.concat(tokens, F.array(F.lit(vocabulary.end))) if ending else tokens).alias("tokens"))


def _regroup(rows: pa.Array, parts: pa.Array, values: pa.Array) -> pa.Array:
    """``parts`` holds one list per element of ``rows``; give each row the values of its elements."""
    per_part = np.concatenate([[0], np.cumsum(parts.value_lengths().to_numpy(zero_copy_only=False))])
    per_row = np.concatenate([[0], np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(per_part[per_row].astype(np.int32)), values)


def decode(encoded: DataFrame, key: str, vocabulary: Vocabulary) -> DataFrame:
    """``key, text`` of token arrays; the end-of-text token has no text."""
    words = [b""] * (max(vocabulary.end, *vocabulary.ranks.values()) + 1)
    for token, rank in vocabulary.ranks.items():
        words[rank] = token
    shipped = encoded.sparkSession.sparkContext.broadcast(words)

    table: list[pa.Array] = []

    def bytes_of(column: pa.Array) -> pa.Array:
        if not table:
            table.append(pa.array(shipped.value, pa.binary()))
        spelled = table[0].take(column.flatten())
        ends = np.frombuffer(spelled.buffers()[1], np.int32)[: len(spelled) + 1]
        per_row = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
        return pa.Array.from_buffers(
            pa.binary(), len(column), [None, pa.py_buffer(ends[per_row].astype(np.int32)), spelled.buffers()[2]]
        )

    raw = sliced_udf(bytes_of, T.BinaryType())(F.col("tokens"))
    return encoded.select(key, F.make_valid_utf8(raw.cast("string")).alias("text"))
