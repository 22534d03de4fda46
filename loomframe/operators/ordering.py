"""Running values over an ordered table, spread over many tasks.

A window with no partition column puts the whole table in one task, and a window partitioned by a
hot key puts that key in one task. Here the sorted table is cut into ranges instead: every range is
windowed on its own, and what the earlier ranges add up to is carried in from a table with at most
one row per range. The cut points come from a sample and enter the plan as literals, so the range of
a row depends on nothing but its own keys and survives recomputation on another executor.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomframe.session import cut_lineage

ROWS_PER_RANGE_CONF = "spark.loomframe.rowsPerRange"
ROWS_PER_RANGE = 200_000
MAX_RANGES = 4_096
SAMPLES_PER_RANGE = 20
BUCKET_ROWS = 8_192

#: Types of columns that may travel with the keys.
_SMALL = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

_RANGE = "__range"
_MORE = "__earlier"


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is sum, min, or last (last non-null)."""

    kind: str
    value: Column
    current: bool = True  # does the row itself count?

    def total(self, order: Sequence[str]) -> Column:
        if self.kind == "sum":
            return F.sum(self.value)
        if self.kind == "min":
            return F.min(self.value)
        return F.max_by(self.value, F.when(self.value.isNotNull(), F.struct(*order)))

    def over(self, value: Column, window) -> Column:
        if self.kind == "sum":
            return F.sum(value).over(window)
        if self.kind == "min":
            return F.min(value).over(window)
        return F.last(value, ignorenulls=True).over(window)

    def merge(self, carried: Column, local: Column) -> Column:
        if self.kind == "sum":
            # no row before, and none of its own counted: the running sum is zero
            return F.coalesce(carried + local, carried, local, F.lit(0).cast("long"))
        if self.kind == "min":
            return F.least(carried, local)
        return F.coalesce(local, carried)

    def frame(self, window):
        return window.rowsBetween(Window.unboundedPreceding, 0 if self.current else -1)


def rows_per_range(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_PER_RANGE_CONF, str(ROWS_PER_RANGE)))


def key_text(key: str, dtype: T.DataType) -> Column:
    """A key as text that Spark itself writes, so no value passes through the driver's types or time zone."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(key).cast("string")
    if isinstance(dtype, (T.BinaryType, T.StringType)):
        return F.hex(F.col(key).cast("binary"))
    return F.col(key).cast("string")


def literal(text: str | None, dtype: T.DataType) -> str:
    if text is None:
        return f"cast(null as {dtype.simpleString()})"
    if isinstance(dtype, T.TimestampType):
        return f"timestamp_micros({text}L)"
    if isinstance(dtype, T.BinaryType):
        return f"X'{text}'"
    if isinstance(dtype, T.StringType):
        return f"decode(X'{text}', 'UTF-8')"
    return f"cast('{text}' as {dtype.simpleString()})"


def _cuts(narrow: DataFrame, keys: Sequence[str], total: int, size: int) -> list[tuple]:
    """Keys that cut the sorted table into ranges of about equal size, from a sample of bounded size.

    The number of ranges follows from the number of rows, two at least, so that a table of any size
    goes the same way.
    """
    ranges = min(MAX_RANGES, max(2, -(-total // size)))
    fraction = min(1.0, ranges * SAMPLES_PER_RANGE / max(total, 1))
    texts = [key_text(k, narrow.schema[k].dataType).alias(f"k{i}") for i, k in enumerate(keys)]
    sample = narrow.select(*keys).sample(fraction=fraction, seed=11).orderBy(*keys).select(*texts).collect()
    picked = [tuple(sample[len(sample) * i // ranges]) for i in range(1, ranges)] if sample else []
    return list(dict.fromkeys(picked))


def _with_range(df: DataFrame, keys: Sequence[str], cuts: list[tuple]) -> DataFrame:
    """Add the number of cuts at or below the row's keys: a binary search over a literal array."""
    if not cuts:
        return df.withColumn(_RANGE, F.lit(0))
    types = [df.schema[k].dataType for k in keys]
    bounds = F.expr(
        "array("
        + ", ".join(
            "named_struct(" + ", ".join(f"'k{i}', {literal(v, t)}" for i, (v, t) in enumerate(zip(cut, types))) + ")"
            for cut in cuts
        )
        + ")"
    )
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    steps = [1 << bit for bit in range(len(cuts).bit_length() - 1, -1, -1)]

    def above(found: Column, step: Column) -> Column:
        return F.get(bounds, found + step - 1) <= F.col("__key")  # null beyond the last cut

    found = F.aggregate(
        F.array(*[F.lit(step) for step in steps]),
        F.lit(0),
        lambda found, step: F.when(above(found, step), found + step).otherwise(found),
    )
    return df.withColumn("__key", key).withColumn(_RANGE, found).drop("__key")


def running(
    df: DataFrame,
    order: Sequence[str],
    values: dict[str, Running],
    group: Sequence[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """Add running values in ``order`` within ``group``; ``order`` must be unique within a group.

    ``rows`` is an upper bound on the row count where the caller knows one (a parquet row count is
    free, counting a derived table is not). Keys and values are written once; a table that holds
    nothing else is not computed again, any other is read a second time to be given the results.
    """
    size = rows_per_range(df)
    group, order = list(group), list(order)
    inputs = {f"__in_{n}": r.value for n, r in values.items()}
    keys = list(dict.fromkeys([*group, *order]))
    plain = [c for c in df.columns if c not in keys and isinstance(df.schema[c].dataType, _SMALL)]
    narrow = cut_lineage(df.select(*keys, *plain, *[c.alias(n) for n, c in inputs.items()]))
    total = narrow.count() if rows is None else rows
    cuts = _cuts(narrow, group + order, total, size)
    if set(df.columns) <= {*keys, *plain}:
        df = narrow.select(*df.columns, *inputs)
        columns = [c for c in df.columns if c not in inputs]
        values = {n: Running(r.kind, F.col(f"__in_{n}"), r.current) for n, r in values.items()}
    else:
        columns = df.columns

    over_inputs = {n: Running(r.kind, F.col(f"__in_{n}"), r.current) for n, r in values.items()}
    totals = (
        _with_range(narrow, group + order, cuts)
        .groupBy(*group, _RANGE)
        .agg(*[r.total(order).alias(f"__sum_{n}") for n, r in over_inputs.items()])
    )
    before = Window.partitionBy(*group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        totals.select(
            *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
            F.col(_RANGE).alias("__r"),
            F.count(F.lit(1)).over(before).alias(_MORE),
            *[r.over(F.col(f"__sum_{n}"), before).alias(f"__carry_{n}") for n, r in values.items()],
        )
        .where(F.col(_MORE) > 0)  # at most one group runs on into each range
        .drop(_MORE)
    )
    carry = cut_lineage(carry)

    window = Window.partitionBy(_RANGE, *group).orderBy(*order)
    local = _with_range(df, group + order, cuts).withColumns(
        {f"__local_{n}": r.over(r.value, r.frame(window)) for n, r in values.items()}
    )
    match = F.col(_RANGE) == F.col("__r")
    for i, g in enumerate(group):
        match = match & local[g].eqNullSafe(F.col(f"__g{i}"))
    merged = {n: r.merge(F.col(f"__carry_{n}"), F.col(f"__local_{n}")) for n, r in values.items()}
    return local.join(F.broadcast(carry), match, "left").select(
        *[local[c] for c in columns if c not in merged], *[c.alias(n) for n, c in merged.items()]
    )


def row_index(
    df: DataFrame, order: Sequence[str], name: str, group: Sequence[str] = (), rows: int | None = None
) -> DataFrame:
    """Zero-based position of each row in ``order`` within ``group``."""
    return running(df, order, {name: Running("sum", F.lit(1).cast("long"), current=False)}, group, rows)


def trailing(
    df: DataFrame,
    index: str,
    width: int,
    values: dict[str, Column],
    group: Sequence[str] = (),
    bucket_rows: int | None = None,
) -> DataFrame:
    """Evaluate aggregates over the last ``width`` rows, the current one included.

    ``index`` is the dense position from :func:`row_index`. Each group is cut into buckets of
    consecutive positions and every bucket also receives the ``width - 1`` rows before it, so a
    hot group is spread over many tasks and each frame is complete.
    """
    if bucket_rows is not None and bucket_rows < width:
        raise ValueError("a bucket must hold a whole frame")
    size = bucket_rows or max(BUCKET_ROWS, 32 * width)
    own = F.call_function("div", F.col(index), F.lit(size).cast("long"))
    tail = F.col(index) % size >= size - (width - 1)
    homes = F.when(tail, F.array(own, own + 1)).otherwise(F.array(own)) if width > 1 else F.array(own)
    window = (
        Window.partitionBy(*group, "__bucket").orderBy(index).rowsBetween(-(width - 1), Window.currentRow)
    )
    return (
        df.withColumn("__own", own)
        .withColumn("__bucket", F.explode(homes))
        .withColumns({n: c.over(window) for n, c in values.items()})
        .where(F.col("__bucket") == F.col("__own"))
        .drop("__bucket", "__own")
    )
