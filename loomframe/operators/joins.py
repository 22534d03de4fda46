"""Many-to-one joins whose many side may be skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.operators.ordering import rows_per_range
from loomframe.session import cut_lineage

MAX_HOT_KEYS = 10_000


def _spread(hot_rows: DataFrame) -> DataFrame:
    """Add a salt to rows of hot keys, taken from a row's place in the written table: equal rows differ, a reread agrees."""
    placed = cut_lineage(hot_rows)
    return placed.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.col("__salts")).cast("int"))


def lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner",
           rows: int | None = None) -> DataFrame:
    """Join ``left`` to a ``right`` that is unique on ``right_key``; ``how`` is inner or left.

    A key that holds more than its share of the left rows is split by salt, and its right row is
    copied once per salt, so no task gets more than one share of any key. The table of such keys
    has at most ``MAX_HOT_KEYS`` rows whatever the size of the data; where it is empty, the join is a
    plain one. ``rows`` is an upper bound on the left row count where the caller knows one.
    """
    total = left.count() if rows is None else rows
    share = max(rows_per_range(left), -(-total // MAX_HOT_KEYS))
    matched = F.col(left_key) == F.col(right_key)
    hot = cut_lineage(
        left.groupBy(F.col(left_key).alias("__hot")).agg(F.count(F.lit(1)).alias("__n"))
        .where((F.col("__n") > share) & F.col("__hot").isNotNull())
        .select("__hot", F.ceil(F.col("__n") / share).cast("int").alias("__salts"))
    )
    if hot.isEmpty():
        return left.join(right, matched, how)
    hot = F.broadcast(hot)
    rest = left.join(hot, F.col(left_key) == F.col("__hot"), "left_anti").join(right, matched, how)
    salted = _spread(left.join(hot, F.col(left_key) == F.col("__hot"))).drop("__hot", "__salts")
    copies = right.join(hot, F.col(right_key) == F.col("__hot")).withColumn(
        "__copy", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))
    ).drop("__hot", "__salts")
    split = salted.join(copies, matched & (F.col("__salt") == F.col("__copy")), how).drop("__salt", "__copy")
    return rest.union(split)
