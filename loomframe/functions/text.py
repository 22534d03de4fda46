"""Text predicates and projections on columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space a Unicode-aware strip removes. Java's (?U)\s lacks \x1c-\x1f.
SPACE_CLASS = r"\s\x1c-\x1f"


def is_blank(text: Column) -> Column:
    """Null, empty, or white space only."""
    return ~F.coalesce(text.rlike(f"(?U)[^{SPACE_CLASS}]"), F.lit(False))


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    # the possessive run keeps a long inner run of spaces from being rescanned at every start
    return F.regexp_replace(text, f"(?U)\\A[{SPACE_CLASS}]++|(?<![{SPACE_CLASS}])[{SPACE_CLASS}]++\\z", "")


def preview(text: Column, length: int) -> Column:
    """First ``length`` characters on one line."""
    return F.replace(F.substring(text, 1, length), F.lit("\n"), F.lit(" "))


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(~is_blank(F.col(column)))


def with_default(df: DataFrame, name: str, value: object) -> DataFrame:
    """Add ``name`` where the table lacks the column; nulls in an existing column stay null."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))
