"""Queries over scored tables: losses, filters, draws."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.operators import scored
from loomframe.plans.registry import query
from loomframe.plans.tables import LOGITS_SQL, load, logits


@query("masked_loss", """
WITH scored AS (
  SELECT vec_id AS seq, CASE WHEN pos % 4 = 1 THEN -1 ELSE pos END AS label, abs(embedding[pos]::DOUBLE) * 10 AS nll
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)),
batches AS (SELECT seq // 8 AS batch, avg(nll) AS mean, sum(nll) AS total, count(*) AS labels
  FROM scored WHERE label <> -1 GROUP BY 1)
SELECT round(avg(mean), 6) AS loss, round(sum(total) / sum(labels), 6) AS token_loss, count(*) AS batches FROM batches""")
def masked_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq"), F.posexplode("embedding").alias("pos", "value")
    )
    rows = exploded.select(
        "seq", "pos", F.when(F.col("pos") % 4 == 0, -1).otherwise(F.col("pos")).alias("label"),
        (F.abs(F.col("value").cast("double")) * 10).alias("nll"),
    )
    return scored.masked_loss(rows, 8).select(F.round("loss", 6).alias("loss"), F.round("token_loss", 6).alias("token_loss"), "batches")


@query("topk_ties", f"""
WITH {LOGITS_SQL} SELECT ctx_id, token_id, logit FROM logits QUALIFY rank() OVER (PARTITION BY ctx_id ORDER BY logit DESC) <= 5""")
def topk_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored.topk_ties(logits(spark, sf_dir), 5)


@query("nucleus", f"""
WITH {LOGITS_SQL}, w AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY ctx_id)) AS w FROM logits),
p AS (SELECT ctx_id, token_id, w / sum(w) OVER (PARTITION BY ctx_id) AS prob,
             sum(w) OVER (PARTITION BY ctx_id ORDER BY logit DESC, token_id ROWS UNBOUNDED PRECEDING) - w AS before,
             sum(w) OVER (PARTITION BY ctx_id) AS mass FROM w)
SELECT ctx_id, token_id, round(prob, 9) AS prob FROM p WHERE before / mass <= 0.9""")
def nucleus(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "embeddings").agg(F.sum(F.size("embedding"))).first()[0] or 0
    return scored.nucleus(logits(spark, sf_dir), 0.9, rows=table).select("ctx_id", "token_id", F.round("prob", 9).alias("prob"))


@query("weighted_draw", f"""
WITH {LOGITS_SQL}, u AS (
  SELECT *, (('0x' || substr(md5('5|' || ctx_id || '|' || token_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM logits)
SELECT ctx_id, arg_max(token_id, logit / 0.8 - ln(-ln(u))) AS token_id FROM u GROUP BY ctx_id""")
def weighted_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored.weighted_draw(logits(spark, sf_dir), 0.8, seed=5)


@query("sample_items", f"""
WITH {LOGITS_SQL}, scaled AS (SELECT ctx_id, token_id, logit / 0.8 AS logit FROM logits),
top AS (SELECT * FROM scaled QUALIFY rank() OVER (PARTITION BY ctx_id ORDER BY logit DESC) <= 20),
w AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY ctx_id)) AS w FROM top),
p AS (SELECT *, sum(w) OVER (PARTITION BY ctx_id ORDER BY logit DESC, token_id ROWS UNBOUNDED PRECEDING) - w AS before,
             sum(w) OVER (PARTITION BY ctx_id) AS mass FROM w),
u AS (SELECT *, (('0x' || substr(md5('5|' || ctx_id || '|' || token_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
      FROM p WHERE before / mass <= 0.9)
SELECT ctx_id, arg_max(token_id, logit - ln(-ln(u))) AS token_id FROM u GROUP BY ctx_id""")
def sample_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature, top-k, nucleus and draw in the order a generator applies them."""
    return scored.sample_items(logits(spark, sf_dir), 0.8, seed=5, k=20, p=0.9)
