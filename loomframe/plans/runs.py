"""Training-log queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.functions import numbers
from loomframe.operators import batching, runs
from loomframe.plans.registry import query
from loomframe.plans.tables import (
    EVAL_SQL, LOG_SQL, TOKENS_PER_STEP, TOTAL_STEPS, eval_log, load, train_log,
)
from loomframe.plans.text import documents
from loomframe.session import cut_lineage, work_path
from loomframe.sources import logs

_LOG, _EVAL = f"WITH {LOG_SQL}", f"WITH {LOG_SQL}, {EVAL_SQL}"


def event_count(spark: SparkSession, sf_dir: str) -> int:
    return load(spark, sf_dir, "events").count()


def rounded(*names: str, digits: int = 6) -> list[Column]:
    return [F.round(n, digits).alias(n) for n in names]


@query("smooth_metric", f"""{_LOG}
SELECT run, step, round(avg(loss) OVER (PARTITION BY run ORDER BY step ROWS 99 PRECEDING), 9) AS smooth_loss FROM log""")
def smooth_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    smoothed = runs.smooth_metric(train_log(spark, sf_dir), rows=event_count(spark, sf_dir))
    return smoothed.select("run", "step", *rounded("smooth_loss", digits=9))


@query("step_throughput", f"""{_LOG}, gaps AS (
  SELECT *, elapsed_sec - lag(elapsed_sec) OVER w AS gap, tokens_seen - lag(tokens_seen) OVER w AS seen
  FROM log WINDOW w AS (PARTITION BY run ORDER BY step))
SELECT run, step, CASE WHEN gap > 0 THEN round({TOKENS_PER_STEP} / gap, 3) ELSE 0.0 END::DOUBLE AS tokens_per_sec,
       CASE WHEN gap > 0 THEN round(seen / gap, 3) ELSE 0.0 END::DOUBLE AS corrected FROM gaps""")
def step_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = runs.step_throughput(train_log(spark, sf_dir), TOKENS_PER_STEP, rows=event_count(spark, sf_dir))
    return rates.select("run", "step", *rounded("tokens_per_sec", "corrected", digits=3))


@query("adaptive_smooth", f"""{_LOG}, known AS (
  SELECT run, step, grad_norm, count(*) OVER (PARTITION BY run) AS n, row_number() OVER (PARTITION BY run ORDER BY step) AS rn
  FROM log WHERE grad_norm IS NOT NULL)
SELECT a.run, a.step, round(avg(b.grad_norm), 9) AS smoothed
FROM known a JOIN known b ON a.run = b.run AND b.rn BETWEEN a.rn - least(50, a.n // 4) AND a.rn
WHERE a.n > 10 GROUP BY a.run, a.step""")
def adaptive_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    smoothed = runs.adaptive_smooth(train_log(spark, sf_dir), rows=event_count(spark, sf_dir))
    return smoothed.select("run", "step", *rounded("smoothed", digits=9))


@query("running_best", f"""{_EVAL}, best AS (
  SELECT *, coalesce(min(val_loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                     'inf'::DOUBLE) AS best_val_loss FROM evals)
SELECT run, step, val_loss, best_val_loss, val_loss < best_val_loss AS is_best FROM best""")
def running_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = runs.running_best(eval_log(train_log(spark, sf_dir)), rows=event_count(spark, sf_dir))
    return best.select("run", "step", "val_loss", "best_val_loss", "is_best")


@query("eta", f"""{_LOG}
SELECT run, step, round(({TOTAL_STEPS} - step) * elapsed_sec / step, 3) AS eta_sec FROM log""")
def eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = numbers.eta_seconds(F.col("step"), F.col("elapsed_sec"), TOTAL_STEPS)
    return train_log(spark, sf_dir).select("run", "step", F.round(seconds, 3).alias("eta_sec"))


@query("attempts", """
WITH resumed AS (
  SELECT event_type AS run, event_id AS step, value AS elapsed_sec,
         lag(value) OVER (PARTITION BY event_type ORDER BY event_id) AS earlier FROM events)
SELECT run, step, (sum(CASE WHEN elapsed_sec < earlier THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY step))::BIGINT AS attempt_id
FROM resumed""")
def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as a clock that keeps falling back."""
    log = load(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("elapsed_sec")
    )
    return runs.attempts(log, ["step"], rows=event_count(spark, sf_dir)).select("run", "step", "attempt_id")


@query("head_tail_mean", f"""{_LOG}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS back FROM log)
SELECT run, round(avg(loss) FILTER (WHERE step <= 100), 6) AS head_mean, round(avg(loss) FILTER (WHERE back <= 100), 6) AS tail_mean
FROM ranked GROUP BY run""")
def head_tail_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.head_tail(train_log(spark, sf_dir), "loss", 100).select("run", *rounded("head_mean", "tail_mean"))


@query("trend_check", f"""{_LOG}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS back FROM log),
ends AS (SELECT run, avg(loss) FILTER (WHERE step <= 10) AS h, avg(loss) FILTER (WHERE back <= 10) AS t FROM ranked GROUP BY run)
SELECT run, round(h, 6) AS head_mean, round(t, 6) AS tail_mean, t < h AS improved FROM ends""")
def trend_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.trend_check(train_log(spark, sf_dir)).select("run", *rounded("head_mean", "tail_mean"), "improved")


@query("best_point", f"""{_EVAL}, gaps AS (SELECT run, step, CASE WHEN step % 7 > 0 THEN val_loss END AS v FROM evals)
SELECT run, min(v) AS best, arg_min(step, {{'v': v, 's': step}}) FILTER (v IS NOT NULL) AS best_step,
       arg_max(v, step) FILTER (v IS NOT NULL) AS last
FROM gaps GROUP BY run""")
def best_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh evaluation has no value."""
    evals = eval_log(train_log(spark, sf_dir)).withColumn("val_loss", F.when(F.col("step") % 7 > 0, F.col("val_loss")))
    return runs.best_point(evals)


@query("avg_throughput", f"""{_LOG}
SELECT run, max(tokens_seen) AS tokens, max(elapsed_sec) AS seconds, round(max(tokens_seen) / max(elapsed_sec), 6) AS throughput
FROM log GROUP BY run""")
def avg_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.avg_throughput(train_log(spark, sf_dir)).select("run", "tokens", "seconds", *rounded("throughput"))


@query("perplexity", f"{_EVAL} SELECT run, step, round(exp(least(val_loss, 20.0)), 3) AS val_perplexity FROM evals")
def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eval_log(train_log(spark, sf_dir)).select("run", "step", *rounded("val_perplexity", digits=3))


@query("microbatch_rollup", f"""{_LOG}
SELECT run, (step - 1) // 4 AS step, round(avg(loss), 6) AS loss FROM log GROUP BY run, (step - 1) // 4 HAVING count(*) = 4""")
def microbatch_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = train_log(spark, sf_dir).select("run", (F.col("step") - 1).alias("batch_idx"), "loss")
    return runs.microbatch_rollup(losses, 4).select("run", "step", *rounded("loss"))


@query("epoch_plan", f"""{_LOG}
SELECT run, step - 1 AS batch_idx, (step - 1) // 2 AS step, (step - 1) // 2 // 100 AS epoch FROM log""")
def epoch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = F.col("step") - 1
    plan = numbers.epoch_plan(batch, 2, 100)
    return train_log(spark, sf_dir).select("run", batch.alias("batch_idx"), *[c.alias(n) for n, c in plan.items()])


@query("interval_sample", f"{_LOG} SELECT run, step, loss FROM log WHERE step % 10 = 0 AND step > 0")
def interval_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.interval_rows(train_log(spark, sf_dir), 10, skip_zero=True).select("run", "step", "loss")


_PROMPTS = ["A good morning", "Two roads", "The last page says", "Water runs", "Nobody knew"]


@query("prompt_rotation", f"""{_LOG}
SELECT run, step, ({_PROMPTS!r})[(step // 25 % 5 + 1)::INTEGER] AS prompt FROM log WHERE step % 25 = 0""")
def prompt_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.prompt_rotation(train_log(spark, sf_dir), _PROMPTS, 25).select("run", "step", "prompt")


@query("curve_overlay", f"""{_EVAL}
SELECT l.run, l.step, l.loss, e.val_loss, round(e.val_perplexity, 3) AS val_perplexity
FROM log l LEFT JOIN evals e ON e.run = l.run AND e.step = l.step""")
def curve_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every evaluation beside its training row."""
    log = train_log(spark, sf_dir)
    return runs.curve_overlay(log, eval_log(log)).select("run", "step", "loss", "val_loss", *rounded("val_perplexity", digits=3))


@query("curve_downsample", f"""{_LOG}, sized AS (SELECT run, step, loss, step - 1 AS pos, count(*) OVER (PARTITION BY run) AS n FROM log),
kept AS (SELECT * FROM sized WHERE pos % (n // least(50, n)) = 0 AND pos // (n // least(50, n)) < least(50, n)),
ends AS (SELECT *, min(loss) OVER (PARTITION BY run) AS lo, max(loss) OVER (PARTITION BY run) AS hi FROM kept)
SELECT run, step, loss, CASE WHEN hi > lo THEN floor((loss - lo) / (hi - lo) * 40) ELSE 20 END::BIGINT AS bar FROM ends""")
def curve_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.curve_downsample(train_log(spark, sf_dir), rows=event_count(spark, sf_dir)).select("run", "step", "loss", "bar")


_DURATION = """CASE WHEN s < 60 THEN printf('%.0fs', round_even(s, 0)) WHEN s < 3600 THEN printf('%.1fm', round_even(s / 60, 1))
  ELSE floor(s / 3600)::BIGINT || 'h' || floor((s - 3600 * floor(s / 3600)) / 60)::BIGINT || 'm' END"""


@query("format_duration", f"""{_LOG} SELECT run, step, {_DURATION} AS duration FROM (
  SELECT run, step, CASE WHEN step % 2 = 0 THEN floor(loss * 40) * 15 ELSE loss * 40 END AS s FROM log)""")
def format_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the durations are whole quarters of a minute, which tie."""
    seconds = F.when(F.col("step") % 2 == 0, F.floor(F.col("loss") * 40) * 15.0).otherwise(F.col("loss") * 40)
    return train_log(spark, sf_dir).select("run", "step", numbers.format_duration(seconds).alias("duration"))


@query("logged_rounding", f"""{_LOG}
SELECT run, step, round_even(loss, 6) AS loss, round_even(grad_norm, 4) AS grad_norm, round_even(elapsed_sec, 1) AS elapsed_sec, tokens_seen
FROM log""")
def logged_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["run", "step", "loss", "grad_norm", "elapsed_sec", "tokens_seen"]
    return train_log(spark, sf_dir).select(*numbers.as_logged(columns))


@query("lr_schedule", f"""{_LOG}
SELECT run, step, round(CASE WHEN step < 100 THEN (step + 1) * 6e-4::DOUBLE / 100 WHEN step >= 1500 THEN 6e-5::DOUBLE
  ELSE 6e-5::DOUBLE + 0.5 * (1 + cos(pi() * ((step - 100) / 1400.0::DOUBLE))) * (6e-4::DOUBLE - 6e-5::DOUBLE) END, 10) AS lr FROM log""")
def lr_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = numbers.lr_schedule(F.col("step"), 100, 1500, 6e-4, 6e-5)
    return train_log(spark, sf_dir).select("run", "step", F.round(rate, 10).alias("lr"))


@query("token_budget", f"""{_LOG}
SELECT run, step, (step * 10 * 5 * 1024)::BIGINT AS nominal_tokens FROM log""")
def token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_log(spark, sf_dir).select("run", "step", numbers.nominal_tokens(F.col("step"), 10, 5).alias("nominal_tokens"))


@query("run_estimate", f"""{_LOG}, t AS (SELECT run, max(tokens_seen) / max(elapsed_sec) * 40 AS rate FROM log GROUP BY run),
e AS (SELECT run, rate * least(50 / 4.0, 8.0) AS expected FROM t)
SELECT run, round(expected, 6)::DOUBLE AS expected_throughput, round({TOTAL_STEPS * TOKENS_PER_STEP}::DOUBLE / expected / 3600, 6)::DOUBLE AS est_hours,
  CASE WHEN {TOTAL_STEPS * TOKENS_PER_STEP} / expected / 3600 <= 30 THEN 'GOOD'
       WHEN {TOTAL_STEPS * TOKENS_PER_STEP} / expected / 3600 <= 48 THEN 'OK' ELSE 'SLOW' END AS status FROM e""")
def run_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = runs.avg_throughput(train_log(spark, sf_dir))
    estimate = numbers.run_estimate(F.col("throughput") * 40, TOTAL_STEPS * TOKENS_PER_STEP, 50)
    return tested.select("run", *[c.alias(n) for n, c in estimate.items()]).withColumns(
        {n: F.round(n, 6) for n in ("expected_throughput", "est_hours")}
    )


@query("run_summary", f"""{_EVAL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS back FROM log),
r AS (SELECT run, avg(loss) FILTER (WHERE step <= 100) AS h, avg(loss) FILTER (WHERE back <= 100) AS t, min(loss) AS min_loss,
      max(tokens_seen) AS tokens, max(elapsed_sec) AS s FROM ranked GROUP BY run),
b AS (SELECT run, min(val_loss) AS best_val_loss FROM evals GROUP BY run)
SELECT r.run, round(h, 6) AS head_mean, round(t, 6) AS tail_mean, min_loss, best_val_loss,
  round(exp(least(best_val_loss, 20.0)), 6) AS best_perplexity, tokens, round(tokens / s, 6) AS throughput, {_DURATION} AS duration
FROM r LEFT JOIN b ON b.run = r.run""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = train_log(spark, sf_dir)
    summary = runs.run_summary(log, eval_log(log))
    return summary.select(
        "run", *rounded("head_mean", "tail_mean"), "min_loss", "best_val_loss", *rounded("best_perplexity"), "tokens",
        *rounded("throughput"), "duration",
    )


@query("metrics_scan", f"""{_EVAL}, best AS (
  SELECT *, coalesce(min(val_loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                     'inf'::DOUBLE) AS best_val_loss FROM evals)
SELECT step, val_loss, best_val_loss, round(val_perplexity, 6) AS val_perplexity, tokens_seen, elapsed_sec,
       make_timestamp(1704067200000000 + round(elapsed_sec * 1e6)::BIGINT) AS timestamp
FROM best""")
def metrics_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluations written as CSV, an infinite best among them, and read back."""
    best = runs.running_best(eval_log(train_log(spark, sf_dir)), rows=event_count(spark, sf_dir))
    # whole microseconds: start and clock added as doubles lose the last one
    micros = F.lit(1_704_067_200_000_000) + F.round(F.col("elapsed_sec") * 1e6).cast("long")
    stamped = best.withColumn("timestamp", F.timestamp_micros(micros))
    path = work_path(spark, "metrics")
    written = stamped.select(*[
        F.when(F.col(c) == numbers.INFINITY, "inf").otherwise(F.col(c).cast("string")).alias(c) if c == "best_val_loss" else c
        for c in logs.EVAL_SCHEMA.names
    ])
    logs.write_metrics(written, path)
    read = logs.read_metrics(spark, path, logs.EVAL_SCHEMA)
    stamp = F.col("timestamp").cast("timestamp_ntz").alias("timestamp")
    return read.select("step", "val_loss", "best_val_loss", *rounded("val_perplexity"), "tokens_seen", "elapsed_sec", stamp)


@query("jsonl_split", """
SELECT CASE WHEN event_type = 'error' THEN 'eval' ELSE 'train' END AS kind, event_id AS step, value AS loss,
       CASE WHEN event_type <> 'error' THEN (props->>'$.k')::INTEGER END AS epoch, user_id::VARCHAR AS user, NULL::VARCHAR AS broken FROM events
UNION ALL SELECT 'broken', NULL, NULL, NULL, NULL, 'not json ' || event_id FROM events WHERE event_id % 100 = 0""")
def jsonl_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one mixed log of JSON lines with a key of their own and some broken lines, read back and split."""
    is_eval = F.col("event_type") == "error"
    extra = F.from_json("props", "k INT")["k"]
    rows = load(spark, sf_dir, "events").select(
        F.when(is_eval, "eval").alias("type"), F.col("event_id").alias("step"),
        F.when(~is_eval, F.col("value")).alias("loss"), F.when(is_eval, F.col("value")).alias("val_loss"),
        F.when(~is_eval, extra).alias("epoch"), F.col("user_id").alias("user"),
    )
    path = work_path(spark, "jsonl")
    broken = load(spark, sf_dir, "events").where("event_id % 100 = 0").select(F.concat(F.lit("not json "), "event_id").alias("value"))
    logs.to_jsonl(rows).unionByName(broken).write.text(path)
    train, evals, rejects = logs.split_jsonl(logs.read_jsonl(spark, path))
    user = F.col("extra")["user"].cast("string").alias("user")
    nothing = F.lit(None).cast("string").alias("broken")
    return (
        train.select(F.lit("train").alias("kind"), "step", "loss", "epoch", user, nothing)
        .unionByName(evals.select(F.lit("eval").alias("kind"), "step", F.col("val_loss").alias("loss"), F.lit(None).cast("int").alias("epoch"), user, nothing))
        .unionByName(rejects.select(F.lit("broken").alias("kind"), "broken"), allowMissingColumns=True)
    )


@query("metrics_append", f"{_LOG} SELECT run, step, loss FROM log")
def metrics_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches appended to one table, one of them delivered twice, read back."""
    log, path = train_log(spark, sf_dir).select("run", "step", "loss"), work_path(spark, "append")
    for rest in (0, 1, 0):
        logs.append_table(log.where(F.col("step") % 2 == rest), path, batch=str(rest))
    return logs.read_table(spark, path, log.schema)


_EPOCHS = [batching.epoch_sql("(SELECT doc_id, text FROM documents)", "doc_id", epoch, seed=0) for epoch in (1, 2)]


@query("sample_sink", f"""
SELECT split, epoch::INTEGER AS epoch, count(*) AS n, sum(position)::BIGINT AS position_sum, sum(position * (doc_id % 1000))::BIGINT AS order_sum FROM (
  SELECT CASE WHEN ('0x' || substr(md5(text), 1, 8))::BIGINT % 10000 < 500 THEN 'validation' ELSE 'train' END AS split, epoch, position, doc_id
  FROM (SELECT *, 1 AS epoch FROM {_EPOCHS[0]} UNION ALL SELECT *, 2 FROM {_EPOCHS[1]}))
GROUP BY split, epoch""")
def sample_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two epochs of shuffled documents from one numbering, one written after the other, read back folder by folder."""
    docs = documents(spark, sf_dir)
    rows = docs.count()
    tagged = batching.holdout_split(docs, "text", 0.05).select("doc_id", "split")
    based = cut_lineage(batching.base_order(tagged, "doc_id", rows))
    path = work_path(spark, "samples")
    for epoch in (1, 2):
        logs.write_examples(batching.epoch_order(based, "doc_id", epoch=epoch, rows=rows, base="base").drop("base"), path, order="position")
    return spark.read.parquet(path).groupBy("split", "epoch").agg(
        F.count(F.lit(1)).alias("n"), F.sum("position").alias("position_sum"), F.sum(F.col("position") * (F.col("doc_id") % 1000)).alias("order_sum")
    )


def _samples(log: DataFrame) -> DataFrame:
    """Stand-ins for generated samples, made from the log."""
    prompt, text = F.concat(F.lit("at "), F.col("tokens_seen").cast("string")), F.round("loss").cast("long").cast("string")
    return log.select("run", "step", prompt.alias("prompt"), text.alias("text"))


@query("run_report", f"""{_EVAL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS back FROM log),
r AS (SELECT run, avg(loss) FILTER (WHERE step <= 100) AS h, avg(loss) FILTER (WHERE back <= 100) AS t, min(loss) AS lo,
      max(tokens_seen) AS tokens, max(elapsed_sec) AS s FROM ranked GROUP BY run),
b AS (SELECT run, min(val_loss) AS best, count(*) AS n FROM evals GROUP BY run)
SELECT run, unnest(range(12)) AS position, unnest(['| metric | value |', '|---|---|', '| head mean | ' || printf('%.4f', round_even(h, 4)) || ' |',
  '| tail mean | ' || printf('%.4f', round_even(t, 4)) || ' |', '| min loss | ' || printf('%.4f', round_even(lo, 4)) || ' |',
  '| best val loss | ' || printf('%.4f', round_even(best, 4)) || ' |', '| best perplexity | ' || printf('%.2f', round_even(exp(least(best, 20.0)), 2)) || ' |',
  '| throughput | ' || printf('%.0f', round_even(tokens / s, 0)) || ' |', '| duration | ' || {_DURATION} || ' |', '', '| step | val loss | val perplexity |',
  '|---|---|---|']) AS line FROM r JOIN b USING (run)
UNION ALL SELECT run, 11 + row_number() OVER (PARTITION BY run ORDER BY step),
  '| ' || step || ' | ' || printf('%.4f', round_even(val_loss, 4)) || ' | ' || printf('%.2f', round_even(val_perplexity, 2)) || ' |' FROM evals
UNION ALL SELECT run, 12 + n, '' FROM b
UNION ALL SELECT run, 13 + n + least(5, n) - back, 'step ' || step || ': at ' || tokens_seen || ' -> ' || loss::BIGINT FROM ranked JOIN b USING (run) WHERE back <= 5""")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report of each run as ordered rows, every evaluation among them."""
    log = train_log(spark, sf_dir)
    evals = eval_log(log)
    return runs.report_lines(runs.run_summary(log, evals), evals, _samples(log), rows=event_count(spark, sf_dir))
