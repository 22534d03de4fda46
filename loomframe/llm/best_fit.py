"""Best-fit decreasing packing of token sequences, from counts of lengths.

Lengths are whole numbers up to the capacity, so pieces of one length are interchangeable and so are
open bins with the same room. The plan is therefore made from a table of counts with at most
``capacity`` rows: lengths are taken in decreasing order, a segment tree over remaining capacities
gives the tightest open bin in logarithmic time, and what happens to many equal pieces in equal bins
is one line of the plan, an interval of piece ranks against an interval of bins. The result is the
packing that best-fit decreasing gives one piece at a time. Spark then ranks the pieces of each
length and joins the plan; no task sees more than a bucket of them.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomframe.llm.common import cut_lineage, slices

CAPACITY = 1024
#: Pieces that one rank bucket holds on average; the number of buckets grows with the table.
ROWS_PER_BUCKET = 50_000


class RoomTree:
    """Segment tree over remaining capacities: which is the smallest one at or above a size in use?"""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.used = [0] * (2 * self.leaves)

    def add(self, room: int, bins: int) -> None:
        at = self.leaves + room
        while at:
            self.used[at] += bins
            at //= 2

    def tightest(self, size: int) -> int | None:
        at = self.leaves + size
        if self.used[at]:
            return size
        while at > 1:  # up to the first right neighbour in use, then down its left edge
            if at % 2 == 0 and self.used[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.used[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


@dataclass(frozen=True)
class Line:
    """Pieces of ``length`` with rank in [low, high) go to bins from ``first`` on, ``each`` per bin, from ``base``."""

    length: int
    low: int
    high: int
    first: int
    each: int
    base: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Line]:
    """Best-fit decreasing for so many pieces of each length."""
    tree, open_bins = RoomTree(capacity), [[] for _ in range(capacity + 1)]
    lines: list[Line] = []
    bins = 0

    def put(room: int, first: int, count: int) -> None:
        if count and room:
            open_bins[room].append((first, count))
            tree.add(room, count)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens can't be placed")
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                first, count = bins, -(-left // (capacity // length))
                bins += count
            else:
                first, count = open_bins[room].pop()
                tree.add(room, -count)
            each = room // length
            full, rest = min(divmod(left, each), (count, 0))
            taken = full * each + rest
            lines.append(Line(length, rank, rank + taken, first, each, capacity - room))
            put(room - each * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            put(room, first + full + bool(rest), count - full - bool(rest))
            left, rank = left - taken, rank + taken
    return lines


def place(pieces: DataFrame, length: str, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces.

    ``pieces`` is read several times, so pass a written table. Pieces longer than the capacity or of
    length null or below one are an error: cut them first (see :func:`token_pieces`). Equal pieces are
    told apart by ``order``; rows that agree in all of it are interchangeable. An empty table gives an
    empty table. Only counts per length reach the driver (at most ``capacity`` rows), and only the plan
    is broadcast, whose size depends on the capacity and not on the number of pieces.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    buckets = max(1, -(-pieces.count() // ROWS_PER_BUCKET))
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    sized = pieces.select("*", F.col(length).cast("int").alias("__length"), bucket.alias("__bucket"))
    counts = sized.groupBy("__length", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    totals = {row[0]: row[1] for row in counts.groupBy("__length").agg(F.sum("__n")).collect()}
    if None in totals:
        raise ValueError("a piece has no length")
    schema = "__of int, __low long, __high long, __first long, __each int, __base int"
    lines = spark.createDataFrame(
        [(x.length, x.low, x.high, x.first, x.each, x.base) for x in plan(totals, capacity)], schema
    )
    own = Window.partitionBy("__length", "__bucket").orderBy(*order)
    ranked = (
        sized.withColumn("__own", F.row_number().over(own) - 1)
        .join(starts, ["__length", "__bucket"])
        .withColumn("__rank", F.col("__start") + F.col("__own"))
    )
    at = F.col("__rank") - F.col("__low")
    return ranked.join(
        F.broadcast(lines), (F.col("__length") == F.col("__of")) & (F.col("__rank") >= F.col("__low")) & (F.col("__rank") < F.col("__high"))
    ).select(
        *pieces.columns,
        (F.col("__first") + F.floor(at / F.col("__each"))).alias("sequence_id"),
        (F.col("__base") + at % F.col("__each") * F.col("__length")).cast("long").alias("offset"),
    )


#: Runs of blanks from this length on are encoded without the split pattern, whose engine gives up on runs of a million.
LONG_RUN = 100_000


class Vocabulary:
    """Byte-level BPE from a tokenizer file: its ranks, pattern and special strings."""

    #: Fixed value: the split pattern of the byte-level pre-tokenizer.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, file: bytes):
        spec = json.loads(file)
        kinds = spec["model"]["type"], (spec["pre_tokenizer"] or {}).get("type"), spec["normalizer"]
        if kinds != ("BPE", "ByteLevel", None) or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"not a plain byte-level BPE file: {kinds}")
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        spelled = {piece: i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in spelled.items()}
        self.encoding = tiktoken.Encoding("bpe", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = tuple(special)
        self.whole = tokenizers.Tokenizer.from_str(file.decode())

    def encode(self, text: str) -> np.ndarray:
        parts, at = [], 0
        for low, high in long_runs(text, self.special) if len(text) >= LONG_RUN else ():
            parts.append(self.encoding.encode_to_numpy(text[at:low], allowed_special="all"))
            parts.append(np.array(self.whole.encode(text[low:high], add_special_tokens=False).ids, np.uint32))
            at = high
        parts.append(self.encoding.encode_to_numpy(text[at:], allowed_special="all"))
        return np.concatenate(parts)


def long_runs(text: str, special: tuple[str, ...]) -> Iterator[tuple[int, int]]:
    """Where long runs of blanks begin and end that the split pattern makes one piece of.

    A run gives its last blank to what follows, unless that is the end or a special string.
    """
    for run in re.finditer(r"\s+", text):
        low, high = run.span()
        if high - low >= LONG_RUN:
            yield low, high if high == len(text) or text.startswith(special, high) else high - 1


_VOCABULARIES: dict[int, Vocabulary] = {}


def token_pieces(
    df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = 2,
    capacity: int = CAPACITY, with_ids: bool = False,
) -> DataFrame:
    """Encode whole texts, end each with ``end_id`` and cut those longer than the capacity.

    One row per piece: the key, ``piece`` from 0, ``start`` (ids before it), ``length``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers), and ``ids`` if asked for. All
    pieces but the first have the full capacity, so at most one per text is left to fit. A null text
    is empty and has the end id alone; a null key stays null; repeated rows give repeated pieces;
    other columns are left behind. The tokenizer file is read by the driver and broadcast.
    """
    with open(tokenizer_path, "rb") as file:
        source = df.sparkSession.sparkContext.broadcast(file.read())
    schema = T.StructType(
        [df.select(key).schema[0], *[T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32")]]
    )
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = source.value
        if hash(file) not in _VOCABULARIES:
            _VOCABULARIES.clear()
            _VOCABULARIES[hash(file)] = Vocabulary(file)
        vocabulary = _VOCABULARIES[hash(file)]
        for batch in slices(batches, "__text"):
            rows, found = [], []
            for at, value in enumerate(batch.column("__text").to_pylist()):
                ids = np.append(vocabulary.encode(value or ""), end_id).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (start, end) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[start:end]
                    rows.append((at, piece, start, end - start, zlib.crc32(part.tobytes())))
                    if with_ids:
                        found.append(part.astype(np.int64))
            columns = np.array(rows, np.int64).T
            out = [batch.column("__key").take(pa.array(columns[0])), *map(pa.array, columns[1:])]
            if with_ids:
                out.append(pa.ListArray.from_arrays(np.cumsum([0, *map(len, found)], dtype=np.int32), np.concatenate(found)))
            yield pa.RecordBatch.from_arrays(out, schema.names)

    return df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(run, schema)


def pack(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all texts with their place: :func:`token_pieces`, written once, then :func:`place`."""
    pieces = cut_lineage(token_pieces(df, tokenizer_path, key, text, end_id, capacity))
    return place(pieces, "length", [key, "piece", "start", "ids_crc32"], capacity)
