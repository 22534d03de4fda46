"""Readers for corpora, messages and instruction pairs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a stream of its files, all there are per micro-batch or ``files_per_trigger``.

    A stream refuses the plain path of a table that is a single file, so the path is given as a
    pattern that matches only itself; it works for a folder of files just the same.
    """
    source = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        source = source.option("maxFilesPerTrigger", files_per_trigger)
    path = path.rstrip("/")
    if re.search(r"[\\*?\[\]{}]", path):
        raise ValueError(f"{path}: a stream would take this name for a pattern")
    return source.parquet(f"{path[:-1]}[{path[-1]}]")


def read_corpus(spark: SparkSession, path: str, text: str = "text", order: str = "doc_id", keep: tuple[str, ...] = (),
                streaming_schema: T.StructType | None = None) -> DataFrame:
    """Text documents; with a schema the same read as a stream."""
    table = spark.read.parquet(path) if streaming_schema is None else read_stream(spark, path, streaming_schema)
    return table.select(order, text, *keep)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows out evenly by ``key``, for work that costs more than moving its input."""
    return df.repartition(key)


def read_messages(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Message rows of one split; a split column in the path prunes folders."""
    messages = spark.read.parquet(path)
    return messages.where(F.col("split") == split) if split is not None else messages


def read_instructions(spark: SparkSession, path: str) -> DataFrame:
    """Instruction pairs; a table without an input column has no inputs."""
    pairs = spark.read.parquet(path)
    if "input" not in pairs.columns:
        pairs = pairs.withColumn("input", F.lit(""))
    return pairs
