"""The operators as queries over the driver tables, and the SQL some of them are checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm import ball_tree, best_fit, chat_machine, conversation_repair, language_mix, minhash, outliers, page_diff, piece_bpe, rotation_codes, substring_dedup, toxicity, winnowing
from loomframe.llm.common import crc_fold, cut_lineage, documents, read
from loomframe.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rotation_codes.near_duplicates(read(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("component", "component_id")


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup(documents(spark, sf_dir).select("doc_id", "text"))
    kept = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", kept)


@query
def op3_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ["lang", "source"]
    stats = outliers.statistics(documents(spark, sf_dir).select("doc_id", "text", *groups))
    stats = cut_lineage(stats.select("doc_id", *groups, *outliers.STATISTICS))
    found = outliers.judge(stats, outliers.fit(stats, groups), groups)
    return found.select("doc_id", *outliers.STATISTICS, "base_failed", "kept", "distance")


@query
def op4_chat_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_machine.read_back(chat_machine.format_turns(turns))


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = minhash.near_duplicates(docs, shingle=3, percent=85)
    return found.withColumnRenamed("component", "component_id")


@query
def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language_mix.learn(docs, where=crc_fold("doc_id") != 0)
    found = language_mix.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (crc_fold("doc_id") == 0).alias("held_out"), "lang_pred", "score", "proportions")


@query
def op7_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_diff.extract(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op8_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    placed = best_fit.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return placed.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"), where=crc_fold("doc_id") != 0)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", (crc_fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op10_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    coded = piece_bpe.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op11_integer_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair(conversation_repair.damage(turns), keys=turns)


@query
def op12_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.search(documents(spark, sf_dir), read(spark, sf_dir, "benchmark"))


@query
def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.against_next(documents(spark, sf_dir))
