"""The streaming operators over the driver tables, run until the input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.functions.text import drop_blank
from loomframe.operators.packing import shift
from loomframe.operators.tokens import BYTES
from loomframe.plans.registry import query
from loomframe.plans.tables import BLOCK, TOKENS_PER_STEP, TOKENS_SQL, load
from loomframe.plans.text import block_digest, blocks_sql, total, weighted_total
from loomframe.session import work_path
from loomframe.sources.corpus import read_corpus, read_stream
from loomframe.streaming.metrics import LiveMetrics
from loomframe.streaming.pack import StreamPacker, encode_stream, run_to_files


def document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = load(spark, sf_dir, "documents").schema
    return read_corpus(spark, f"{sf_dir}/documents.parquet", streaming_schema=schema)


@query("stream_encode", f"""
WITH {TOKENS_SQL}
SELECT t.doc_id, count(*)::BIGINT AS n_tokens, sum(tok)::BIGINT AS token_sum, sum(tok * (loc - start))::BIGINT AS token_dot
FROM tokens t JOIN offsets o ON o.doc_id = t.doc_id GROUP BY t.doc_id""")
def stream_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "stream-encode")
    run_to_files(encode_stream(document_stream(spark, sf_dir), "doc_id", "text"), path)
    done = spark.read.schema("doc_id long, tokens array<int>").parquet(f"{path}/rows")
    return done.select(
        "doc_id", F.size("tokens").cast("long").alias("n_tokens"), total(F.col("tokens")).alias("token_sum"),
        weighted_total(F.col("tokens")).alias("token_dot"),
    )


def packer(spark: SparkSession, name: str, block: int = BLOCK, max_tokens: int | None = None) -> StreamPacker:
    tokens = BYTES.concat(BYTES.from_text(F.col("text")), BYTES.ending())
    count = BYTES.text_count(F.col("text")) + 1
    return StreamPacker(work_path(spark, name), "doc_id", tokens, count, BYTES, block=block, max_tokens=max_tokens)


def digest(spark: SparkSession, packed: StreamPacker) -> DataFrame:
    return block_digest(shift(packed.blocks(spark), BYTES, packed.block))


@query("stream_pack", f"WITH {TOKENS_SQL}" + blocks_sql("tokens", BLOCK))
def stream_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order over all files, in one micro-batch."""
    packed = packer(spark, "stream-pack")
    packed.run(drop_blank(document_stream(spark, sf_dir), "text"))
    return digest(spark, packed)


@query("stream_resume", f"WITH {TOKENS_SQL}" + blocks_sql("tokens", BLOCK))
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents are packed, the stream stops, the other half arrives, and it goes on."""
    packed, docs = packer(spark, "stream-resume"), load(spark, sf_dir, "documents")
    arriving = work_path(spark, "stream-arrivals")
    half = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    for part in (F.col("doc_id") <= half, F.col("doc_id") > half):
        docs.where(part).write.mode("append").parquet(arriving)
        packed.run(drop_blank(read_corpus(spark, arriving, streaming_schema=docs.schema), "text"))
    return digest(spark, packed)


@query("stream_budget", f"WITH {TOKENS_SQL}" + blocks_sql("tokens", 256, "AND b < 320"))
def stream_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing that stops at a token budget."""
    packed = packer(spark, "stream-budget", 256, 320 * 256)
    packed.run(drop_blank(document_stream(spark, sf_dir), "text"))
    return digest(spark, packed)


@query("stream_metrics", f"""
WITH log AS (SELECT event_type AS run, event_id AS step, value AS loss, (epoch_us(ts) - 1704067200000000) / 1e6 AS elapsed_sec,
                    event_id * {TOKENS_PER_STEP} AS tokens_seen FROM events),
w AS (SELECT *, avg(loss) OVER (PARTITION BY run ORDER BY step ROWS 99 PRECEDING) AS smooth,
        elapsed_sec - lag(elapsed_sec) OVER (PARTITION BY run ORDER BY step) AS gap,
        min(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM log)
SELECT run, step, round(smooth, 9) AS smooth_loss, CASE WHEN gap > 0 THEN round({TOKENS_PER_STEP} / gap, 3) ELSE 0.0 END::DOUBLE AS tokens_per_sec,
       coalesce(best, 'inf'::DOUBLE) AS best_loss FROM w""")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = load(spark, sf_dir, "events").schema
    events = read_stream(spark, f"{sf_dir}/events.parquet", schema)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    log = events.select(
        F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss"),
        (F.timestamp_diff("MICROSECOND", start, "ts") / 1e6).alias("elapsed_sec"),
        (F.col("event_id") * TOKENS_PER_STEP).alias("tokens_seen"),
    )
    live = LiveMetrics(work_path(spark, "stream-metrics"), TOKENS_PER_STEP)
    live.run(log)
    return live.rows(spark).select(
        "run", "step", F.round("smooth_loss", 9).alias("smooth_loss"), F.round("tokens_per_sec", 3).alias("tokens_per_sec"), "best_loss"
    )
