"""From raw documents to packed training sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm import best_fit, minhash, outliers, substring_dedup, toxicity
from loomframe.llm.common import crc_fold, cut_lineage, documents, read

GROUPS = ["lang", "source"]

#: No SQL: the estimates of the first two stages are learned by iteration.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test of their language and source let pass."""
    stats = cut_lineage(outliers.statistics(docs))
    return outliers.judge(stats, outliers.fit(stats, GROUPS), GROUPS).where("kept").select(docs.columns)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; held-out labels are not learned from."""
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"), where=crc_fold("doc_id") != 0)
    return toxicity.score(docs, model, name="__toxicity").where("__toxicity < 0.5").select(docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    gone = cut_lineage(minhash.near_duplicates(docs).where("not kept").select("doc_id"))
    return docs.join(gone, "doc_id", "left_anti")


def distinct_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 20 words and more that an earlier one holds; whole ones keep their white space."""
    found = substring_dedup.dedup(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    found = found.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    )
    return found.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' token pieces in training sequences."""
    placed = best_fit.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return placed.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality),
    ("toxicity", harmless),
    ("minhash near-dedup", distinct_documents),
    ("substring dedup", distinct_passages),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage returns is written and read again by the next."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
