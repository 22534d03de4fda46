"""How a token sequence travels through a plan.

A carrier says how to count, cut, join and finally read out tokens. Token arrays carry themselves.
Byte tokens travel as the UTF-8 bytes, a quarter of the size of an integer array in a shuffle and
cut without a scan; integers are made once, at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Byte tokens are 0..255, so the end-of-text token takes the next id. On the way it is
# the byte 0xFF, which no valid UTF-8 text contains.
BYTE_END = 256
END_MARK = 0xFF
# Bytes of text, or tokens, that a Python worker turns into results at a time; a longer row goes alone
SLICE_VALUES = 1 << 20


class Carrier(Protocol):
    end: int

    def from_text(self, text: Column) -> Column: ...
    def from_literal(self, text: str) -> Column: ...
    def text_count(self, text: Column) -> Column: ...
    def ending(self) -> Column: ...
    def count(self, tokens: Column) -> Column: ...
    def cut(self, tokens: Column, skip: Column, length: Column) -> Column: ...
    def concat(self, *tokens: Column) -> Column: ...
    def join(self, pieces: Column) -> Column: ...
    def ids(self, tokens: Column) -> Column: ...


@dataclass(frozen=True)
class ByteCarrier:
    end: int = BYTE_END

    def from_text(self, text: Column) -> Column:
        return F.make_valid_utf8(text).cast("binary")

    def from_literal(self, text: str) -> Column:
        return F.lit(text.encode())

    def text_count(self, text: Column) -> Column:
        return F.octet_length(F.make_valid_utf8(text)).cast("long")

    def ending(self) -> Column:
        return F.lit(bytes([END_MARK]))

    def count(self, tokens: Column) -> Column:
        return F.octet_length(tokens).cast("long")

    def cut(self, tokens: Column, skip: Column, length: Column) -> Column:
        return F.substring(tokens, (skip + 1).cast("int"), length.cast("int"))

    def concat(self, *tokens: Column) -> Column:
        return F.concat(*tokens)

    def join(self, pieces: Column) -> Column:
        return F.array_join(F.transform(pieces, lambda p: p.cast("string")), "").cast("binary")

    def ids(self, tokens: Column) -> Column:
        return sliced_udf(_bytes_to_ids, T.ArrayType(T.IntegerType()))(tokens)


def _values(column: pa.Array) -> np.ndarray:
    """What each row holds: bytes of a string, elements of a list, bytes and pieces of a list of strings."""
    if not pa.types.is_list(column.type):
        return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not pa.types.is_string(column.type.value_type):
        return lengths
    held = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(column.flatten()), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return np.diff(held[ends]) + lengths


def slices(column: pa.Array, limit: int = SLICE_VALUES) -> Iterator[pa.Array]:
    """Runs of rows that hold about ``limit`` values."""
    sizes = _values(column)
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // limit)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(column)]):
        if end > start:
            yield column.slice(start, end - start)


def sliced_udf(convert: Callable[[pa.Array], pa.Array], dtype: T.DataType) -> Callable[[Column], Column]:
    """``convert`` over slices of Arrow batches.

    Spark bounds the batches that it sends, by rows and bytes. Results are several times as large, so they
    are made and sent back slice by slice, and a worker holds no more of them however long the texts are.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield from map(convert, slices(column))
            del column  # before the next one is read

    return F.arrow_udf(run, dtype)


def _bytes_to_ids(column: pa.Array) -> pa.Array:
    """Widen a slice of byte strings at once; nothing runs per row."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8)
    ids = values.astype(np.int32)
    ids[ids == END_MARK] = BYTE_END
    nulls = column.is_null() if column.null_count else None
    return pa.ListArray.from_arrays(pa.array(ends - ends[0]), pa.array(ids), mask=nulls)


def _ids_to_bytes(column: pa.Array) -> pa.Array:
    """The reverse, with end-of-text tokens left out."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    kept = values < BYTE_END
    row = np.repeat(np.arange(len(column)), lengths)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(column)))]).astype(np.int32)
    data = values[kept].astype(np.uint8)
    spelled = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return pc.if_else(column.is_null(), None, spelled) if column.null_count else spelled


@dataclass(frozen=True)
class ArrayCarrier:
    """Tokens already encoded to ``array<int>``; ``end`` is the vocabulary's end-of-text id."""

    end: int

    def from_text(self, text: Column) -> Column:
        raise TypeError("encode the text first: token arrays cannot be made inside an expression")

    def from_literal(self, text: str) -> Column:
        return self.from_text(F.lit(text))

    def text_count(self, text: Column) -> Column:
        raise TypeError("encode the text first: token arrays cannot be made inside an expression")

    def ending(self) -> Column:
        return F.array(F.lit(self.end))

    def count(self, tokens: Column) -> Column:
        return F.size(tokens).cast("long")

    def cut(self, tokens: Column, skip: Column, length: Column) -> Column:
        return F.slice(tokens, (skip + 1).cast("int"), length.cast("int"))

    def concat(self, *tokens: Column) -> Column:
        return F.concat(*tokens)

    def join(self, pieces: Column) -> Column:
        return F.flatten(pieces)

    def ids(self, tokens: Column) -> Column:
        return tokens


BYTES = ByteCarrier()


def encode_bytes(text: Column) -> Column:
    """Byte tokens of a document followed by the end-of-text token."""
    return BYTES.ids(BYTES.concat(BYTES.from_text(text), BYTES.ending()))


def decode_bytes(ids: Column) -> Column:
    """Text of a byte-token array, separators left out."""
    return F.make_valid_utf8(sliced_udf(_ids_to_bytes, T.BinaryType())(ids).cast("string"))
