"""Catalogue of saved model files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: how a step's file is named
STEP_FILE = r"(?:^|/)step_(\d+)\.pt$"


def list_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Paths below a folder; the files themselves are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")


def step_artifacts(paths: DataFrame) -> DataFrame:
    """``path, folder, step`` of the files named after a step."""
    return paths.where(F.col("path").rlike(STEP_FILE)).select(
        "path",
        F.regexp_replace("path", r"/?[^/]*$", "").alias("folder"),
        F.regexp_extract("path", STEP_FILE, 1).cast("long").alias("step"),
    )


def latest_artifact(paths: DataFrame) -> DataFrame:
    """The file with the highest step in each folder."""
    return step_artifacts(paths).groupBy("folder").agg(F.max_by("path", "step").alias("path"), F.max("step").alias("step"))
