"""Splits, epoch order and fixed-size batches."""

from __future__ import annotations

import hashlib
import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.ordering import row_index
from loomframe.operators.packing import whole

SPLIT_STEPS = 10_000


def text_share(text: Column) -> Column:
    """A number in 0..9999 fixed by the text, so that copies always fall together."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % SPLIT_STEPS


def holdout_split(docs: DataFrame, text: str, ratio: float) -> DataFrame:
    """Tag each document ``validation`` or ``train``; no text is in both."""
    held = text_share(F.coalesce(F.col(text), F.lit(""))) < round(ratio * SPLIT_STEPS)
    return docs.withColumn("split", F.when(held, "validation").otherwise("train"))


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All rows of all sources, tagged with the name of their source."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def source_counts(df: DataFrame) -> DataFrame:
    """Examples per source and split with subtotals and the total (null keys)."""
    return df.rollup("source", "split").agg(F.count(F.lit(1)).alias("n"))


#: Rounds of the permutation, each with a key of its own.
ROUNDS = 6
#: Fixed value: the largest prime below 2**32, the modulus of the round function.
PRIME = 4_294_967_291
#: Most further steps from a number beyond the last position back into the positions.
MAX_WALK = 64


def round_keys(epoch: int, seed: int) -> list[int]:
    """Whole numbers below 2**30 that an epoch's permutation is keyed by."""
    return [int(hashlib.md5(f"{seed}|{epoch}|{i}".encode()).hexdigest()[:8], 16) >> 2 for i in range(ROUNDS)]


def sides(total: int) -> tuple[int, int]:
    """A rectangle of little more than ``total`` cells."""
    wide = math.isqrt(max(total, 1) - 1) + 1
    return wide, -(-max(total, 1) // wide)


def round_value(half: str, key: int) -> str:
    """The round function in SQL of whole numbers, ``//`` for division; no step leaves 64 bits."""
    return f"((({half} + {key}) * 2654435761 % {PRIME} // 1009 * 40503 + {key}) % {PRIME} // 31)"


def permuted(base: str, wide: int | str, high: int | str, epoch: int, seed: int) -> str:
    """One step of a keyed permutation of 0 .. wide * high - 1, in the same SQL.

    A Feistel network on the sides of a rectangle: each round moves one coordinate by a function of
    the other, so it can be undone, whatever the sides are.
    """
    left, right = f"({base} % {wide})", f"({base} // {wide})"
    for i, key in enumerate(round_keys(epoch, seed)):
        if i % 2:
            right = f"(({right} + {round_value(left, key)}) % {high})"
        else:
            left = f"(({left} + {round_value(right, key)}) % {wide})"
    return f"({left} + {wide} * {right})"


def epoch_position(base: str, total: int, epoch: int, seed: int = 0) -> Column:
    """The position in an epoch of the row numbered ``base`` (0 .. total - 1): a permutation, computed row by row.

    The rectangle has fewer cells beyond the rows than a side of it. A row that lands on one of them
    is permuted on until it comes to a position; one that takes more than ``MAX_WALK`` further steps,
    which is next to impossible, is an error and never a wrong position.
    """
    wide, high = sides(total)
    if wide >= 1 << 31:
        raise ValueError("too many rows")

    def step(at: str) -> str:
        return permuted(at, f"{wide}L", f"{high}L", epoch, seed).replace("//", "div")

    walk = f"aggregate(sequence(1, {MAX_WALK}), one, (at, i) -> CASE WHEN at < {total} THEN at ELSE {step('at')} END)"
    found = F.expr(f"transform(array({step(f'cast({base} as long)')}), one -> CASE WHEN one < {total} THEN one ELSE {walk} END)[0]")
    return F.when(found < total, found).otherwise(F.raise_error(F.lit("no position within the steps allowed")).cast("long"))


def base_order(df: DataFrame, key: str, rows: int | None = None, name: str = "base") -> DataFrame:
    """Number the rows by key, once for all epochs."""
    return row_index(df, [key], name, rows=rows)


def epoch_order(df: DataFrame, key: str, epoch: int, seed: int = 0, rows: int | None = None, base: str | None = None) -> DataFrame:
    """Add ``epoch`` and ``position``: a different order every epoch, the same on every rerun.

    With ``base``, a column of :func:`base_order`, no epoch sorts again: its positions are computed row
    by row. ``rows`` is the number of rows where the caller knows it.
    """
    total = df.count() if rows is None else rows
    based = base_order(df, key, total, "__base") if base is None else df.withColumn("__base", F.col(base))
    return based.withColumn("position", epoch_position("__base", total, epoch, seed)).drop("__base").withColumn("epoch", F.lit(epoch))


def epoch_sql(source: str, key: str, epoch: int, seed: int) -> str:
    """The same positions in SQL over ``source``: all its columns and ``position``."""
    return f"""(
  WITH RECURSIVE based AS (SELECT *, row_number() OVER (ORDER BY {key}) - 1 AS base, count(*) OVER () AS n FROM {source}),
  sized AS (SELECT *, ceil(sqrt(n))::BIGINT AS wide FROM based),
  walk AS (
    SELECT *, (n + wide - 1) // wide AS high, {permuted("base", "wide", "((n + wide - 1) // wide)", epoch, seed)} AS spot FROM sized
    UNION ALL SELECT * REPLACE ({permuted("spot", "wide", "high", epoch, seed)} AS spot) FROM walk WHERE spot >= n)
  SELECT * EXCLUDE (base, n, wide, high, spot), spot AS position FROM walk WHERE spot < n)"""


def make_batches(
    df: DataFrame, position: str, size: int, drop_last: bool = False, total: int | None = None
) -> DataFrame:
    """Number the batches of ``size`` consecutive positions; optionally drop a short last one.

    ``total`` is the number of rows, counted here if the caller does not know it.
    """
    batched = df.withColumn("batch", whole(F.col(position), size))
    if not drop_last:
        return batched
    total = df.count() if total is None else total
    return batched.where(F.col(position) < total - total % size)
