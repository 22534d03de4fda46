"""What several operators share: words, slices of Arrow batches, hashes, tables that cut lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.session import cut_lineage

#: Text that one Python task holds decoded at a time; a longer single text is a slice of its own.
SLICE_BYTES = 4 << 20
#: Entries of a per-worker memo before it is emptied.
MEMO_ENTRIES = 300_000
#: Words for Spark's regular expressions; ``bytes.split()`` cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"

BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)

__all__ = [
    "BASE", "SLICE_BYTES", "WORD", "Memo", "crc_fold", "cut_lineage", "documents", "read", "run_hashes", "slices", "sliding_min", "word_hash",
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose ``column`` holds about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(start, end - start)


class Memo(dict):
    """Values of a function by key, emptied when it holds too many."""

    def __init__(self, function: Callable, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.function, self.entries = function, entries

    def __missing__(self, key):
        if len(self) >= self.entries:
            self.clear()
        value = self[key] = self.function(key)
        return value


def word_hash() -> Memo:
    """64-bit hashes of words given as bytes."""
    return Memo(xxhash.xxh64_intdigest)


def crc_fold(column: str, folds: int = 5):
    """crc32 of the decimal text of an id, modulo ``folds``; 0 marks held-out rows."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


def _powers(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def run_hashes(words: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of each run of ``length`` words, by doubling; position i is valid up to the end."""
    total, done = np.zeros_like(words), 0
    part, size = words, 1
    while True:
        if length & size:  # put the runs of this size after what is there
            moved = np.zeros_like(words)
            moved[: len(words) - done if done else None] = part[done:]
            total = total * _powers(base, size) + moved
            done += size
        if done == length:
            return total
        moved = np.zeros_like(words)
        moved[:-size or None] = part[size:]
        part, size = part * _powers(base, size) + moved, size * 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values from a position on."""
    part, size = values, 1
    while size * 2 <= width:
        moved = np.full_like(part, _LAST)
        moved[:-size or None] = part[size:]
        part, size = np.minimum(part, moved), size * 2
    if size < width:
        moved = np.full_like(part, _LAST)
        moved[: size - width] = part[width - size :]
        part = np.minimum(part, moved)
    return part
