"""The inputs the queries share, derived from the driver tables, and the same derivations in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.functions.numbers import perplexity
from loomframe.operators.chat import PROMPTER, map_roles
from loomframe.operators.ordering import row_index

BLOCK = 1024
TOKENS_PER_STEP = 51_200
TOTAL_STEPS = 28_000
ROLE_NAMES = {"user": PROMPTER}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a training log: one run per event type, steps in time order."""
    events = load(spark, sf_dir, "events")
    stepped = row_index(events, ["ts", "event_id"], "step0", ["event_type"], rows=events.count())
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return stepped.select(
        F.col("event_type").alias("run"),
        (F.col("step0") + 1).alias("step"),
        F.col("value").alias("loss"),
        (F.timestamp_diff("MICROSECOND", start, "ts") / 1e6).alias("elapsed_sec"),
        ((F.col("step0") + 1) * TOKENS_PER_STEP).alias("tokens_seen"),
        F.when(F.col("user_id") % 5 != 0, F.col("value") / 10).alias("grad_norm"),
        F.col("ts"),
    )


LOG_SQL = f"""log AS (
  SELECT event_type AS run, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS step,
         value AS loss, (epoch_us(ts) - 1704067200000000) / 1e6 AS elapsed_sec,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) * {TOKENS_PER_STEP} AS tokens_seen,
         CASE WHEN user_id % 5 <> 0 THEN value / 10 END AS grad_norm, ts
  FROM events)"""


def eval_log(log: DataFrame) -> DataFrame:
    """Every log row as an evaluation."""
    val = F.col("loss") / 20
    return log.select(
        "run", "step", val.alias("val_loss"), perplexity(val).alias("val_perplexity"), "tokens_seen", "elapsed_sec"
    )


EVAL_SQL = """evals AS (
  SELECT run, step, loss / 20 AS val_loss, exp(least(loss / 20, 20.0)) AS val_perplexity, tokens_seen, elapsed_sec
  FROM log)"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_roles(load(spark, sf_dir, "conversations"), ROLE_NAMES)


TURNS_SQL = """turns AS (
  SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'prompter' ELSE role END AS role, text FROM conversations)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three conversations each as one tree: the later ones open as replies to the first one's opening."""
    chats = turns(spark, sf_dir).withColumn("grp", F.floor(F.col("conv_id") / 3))
    first = chats.groupBy("grp").agg(F.min("conv_id").alias("root_conv"))
    rows = chats.join(first, "grp")
    ident = F.col("conv_id") * 1000 + F.col("turn")
    reply = F.when(F.col("conv_id") != F.col("root_conv"), F.col("root_conv") * 1000)
    parent = F.when(F.col("turn") > 0, ident - 1).otherwise(reply)
    return rows.select(
        ident.alias("ord"), ident.alias("message_id"), parent.alias("parent_id"), "role", "text",
        F.when(F.col("conv_id") % 7 == 0, "de").otherwise("en").alias("lang"),
    )


MESSAGES_SQL = TURNS_SQL + """, grouped AS (
  SELECT *, min(conv_id) OVER (PARTITION BY conv_id // 3) AS root_conv FROM turns),
messages AS (
  SELECT conv_id * 1000 + turn AS ord, conv_id * 1000 + turn AS message_id,
         CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 WHEN conv_id <> root_conv THEN root_conv * 1000 END AS parent_id,
         role, text, CASE WHEN conv_id % 7 = 0 THEN 'de' ELSE 'en' END AS lang
  FROM grouped)"""


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every exchange of each conversation; a system turn before it is the input."""
    chats = turns(spark, sf_dir)
    asked = chats.where(F.col("role") == PROMPTER).select(
        "conv_id", "turn", F.col("text").alias("instruction")
    )
    answered = chats.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    system = chats.where(F.col("role") == "system").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("input")
    )
    return (
        asked.join(answered, ["conv_id", "turn"]).join(system, ["conv_id", "turn"], "left")
        .select((F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"), "instruction", "input", "output")
    )


INSTRUCTIONS_SQL = TURNS_SQL + """, instructions AS (
  SELECT u.conv_id * 1000 + u.turn AS pair_id, u.text AS instruction, s.text AS input, a.text AS output
  FROM turns u JOIN turns a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN turns s ON s.conv_id = u.conv_id AND s.turn = u.turn - 1 AND s.role = 'system'
  WHERE u.role = 'prompter')"""


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding components as scores of the items of a context, coarse enough to tie."""
    return load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("ctx_id"), F.posexplode("embedding").alias("token_id", "value")
    ).select("ctx_id", "token_id", F.round(F.col("value").cast("double") * 20, 1).alias("logit"))


LOGITS_SQL = """logits AS (
  SELECT vec_id AS ctx_id, pos - 1 AS token_id, round(embedding[pos]::DOUBLE * 20, 1) AS logit
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1))::INTEGER AS pos FROM embeddings))"""

# Unicode white space spelled out: RE2 knows only the ASCII part of \\s
SQL_SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

# One row per byte token of each document, end-of-text last
TOKENS_SQL = f"""docs AS (SELECT doc_id, text FROM documents WHERE regexp_matches(text, '[^{SQL_SPACE}]')),
offsets AS (
  SELECT doc_id, text, octet_length(encode(text)) + 1 AS n,
         sum(octet_length(encode(text)) + 1) OVER (ORDER BY doc_id) - octet_length(encode(text)) - 1 AS start FROM docs),
tokens AS (
  SELECT doc_id, start + i AS loc, tok FROM (
    SELECT doc_id, start, unnest(range(n)) AS i,
           unnest(list_append(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::INTEGER), 256)) AS tok
    FROM offsets))"""
