import math
import re
import random

import pytest
from pyspark.sql import functions as F

from loomframe.functions import numbers
from loomframe.operators import runs


def make_log(n=130, seed=2):
    rng = random.Random(seed)
    rows = []
    for run, size in (("hot", n), ("short", 9), ("mid", 40)):
        clock = 0.0
        for step in range(size):
            clock += rng.choice([0.0, 1.5, 2.0])
            norm = None if rng.random() < 0.2 else round(rng.uniform(0, 3), 3)
            rows.append((run, step * 10, round(rng.uniform(1, 9), 3), clock, (step + 1) * 500, norm))
    return rows


SCHEMA = "run string, step long, loss double, elapsed_sec double, tokens_seen long, grad_norm double"


@pytest.fixture
def log(spark):
    rows = make_log()
    return spark.createDataFrame(rows, SCHEMA).repartition(4), rows


def series(rows, run):
    return sorted(r for r in rows if r[0] == run)


def collected(df, *names):
    return {(r.run, r.step): tuple(r[n] for n in names) for r in df.collect()}


def test_smoothing_and_throughput(log, ranges):
    df, rows = log
    smooth = collected(runs.smooth_metric(df, width=20), "smooth_loss")
    rates = collected(runs.step_throughput(df, 51200), "tokens_per_sec", "corrected")
    for run in ("hot", "short", "mid"):
        own = series(rows, run)
        for i, row in enumerate(own):
            recent = [r[2] for r in own[max(0, i - 19) : i + 1]]
            assert smooth[run, row[1]][0] == pytest.approx(sum(recent) / len(recent))
            gap = row[3] - own[i - 1][3] if i else 0
            want = (51200 / gap, 500 / gap) if gap > 0 else (0.0, 0.0)
            assert rates[run, row[1]] == pytest.approx(want)


def test_adaptive_window(log, ranges):
    df, rows = log
    got = collected(runs.adaptive_smooth(df), "smoothed")
    seen = 0
    for run in ("hot", "short", "mid"):
        known = [r for r in series(rows, run) if r[5] is not None]
        window = min(50, len(known) // 4)
        for i, row in enumerate(known):
            part = [r[5] for r in known[max(0, i - window) : i + 1]]
            want = sum(part) / len(part) if len(known) > 10 else None
            assert got[run, row[1]][0] == (None if want is None else pytest.approx(want))
            seen += 1
    assert seen == len(got)


def test_adaptive_window_of_values_that_do_not_add_up(spark, ranges):
    values = [1e14 + 0.25, 1e-9, -1e14, 3.5, 1e300, 2.0, 2.5, float("nan"), 1.0, float("inf"), *[0.1] * 30]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "run string, step long, grad_norm double")
    got = [r.smoothed for r in runs.adaptive_smooth(df, max_window=3).orderBy("step").collect()]
    for i, value in enumerate(got):
        part = values[max(0, i - 3) : i + 1]
        odd = any(not abs(v) < 1e15 for v in part)
        assert math.isnan(value) if odd else value == pytest.approx(math.fsum(part) / len(part), rel=1e-12, abs=1e-12)
    assert got[-1] == pytest.approx(0.1, rel=1e-14)
    flat = runs.adaptive_smooth(df)._jdf.queryExecution().toString()
    assert "collect_list" not in flat


def test_running_best(spark, ranges):
    rows = [("a", s, float(v)) for s, v in enumerate([5, 4, 4.5, 3, 3, 7, 2, 9, 1, 1, 0.5])]
    got = runs.running_best(spark.createDataFrame(rows, "run string, step long, val_loss double")).orderBy("step").collect()
    assert [r.best_val_loss for r in got] == [math.inf, 5, 4, 4, 3, 3, 3, 2, 2, 1, 1]
    assert [r.is_best for r in got] == [True, True, False, True, False, False, True, False, True, False, True]


def test_attempts(spark, ranges):
    clock = [1, 2, 3, 1, 2, 2, 5, 0, 1]
    df = spark.createDataFrame([("a", i, float(c)) for i, c in enumerate(clock)], "run string, step long, elapsed_sec double")
    got = runs.attempts(df, ["step"]).orderBy("step").collect()
    assert [r.attempt_id for r in got] == [0, 0, 0, 1, 1, 1, 1, 2, 2]


def test_ends_and_trend(log):
    df, rows = log
    got = {r.run: r for r in runs.trend_check(df, k=10).collect()}
    for run in ("hot", "short", "mid"):
        losses = [r[2] for r in series(rows, run)]
        head, tail = losses[:10], losses[-10:]
        assert got[run].head_mean == pytest.approx(sum(head) / len(head))
        assert got[run].tail_mean == pytest.approx(sum(tail) / len(tail))
        assert got[run].improved == (sum(tail) / len(tail) < sum(head) / len(head))


def test_downsample(log, ranges):
    df, rows = log
    got = collected(runs.curve_downsample(df.select("run", "step", "loss"), points=50, width=40), "bar")
    for run in ("hot", "short", "mid"):
        own = series(rows, run)
        n = min(50, len(own))
        kept = [own[i * (len(own) // n)] for i in range(n)]
        low, high = min(r[2] for r in kept), max(r[2] for r in kept)
        assert {s for r, s in got if r == run} == {r[1] for r in kept}
        for row in kept:
            assert got[run, row[1]][0] == int((row[2] - low) / (high - low) * 40)


def test_flat_curve(spark):
    df = spark.createDataFrame([("a", i, 2.0) for i in range(3)], "run string, step long, loss double")
    assert [r.bar for r in runs.curve_downsample(df).collect()] == [20, 20, 20]


def test_microbatches_and_prompts(spark):
    losses = spark.createDataFrame([("a", i, float(i)) for i in range(11)], "run string, batch_idx long, loss double")
    assert sorted((r.step, r.loss) for r in runs.microbatch_rollup(losses, 4).collect()) == [(0, 1.5), (1, 5.5)]
    steps = spark.createDataFrame([("a", s) for s in range(0, 60, 5)], "run string, step long")
    got = runs.prompt_rotation(steps, ["p", "q"], 10).orderBy("step").collect()
    assert [(r.step, r.prompt) for r in got] == [(10, "q"), (20, "p"), (30, "q"), (40, "p"), (50, "q")]


def test_summary(log):
    df, rows = log
    evals = df.where("step % 50 = 0").withColumn("val_loss", F.col("loss") * 4)
    summary = runs.run_summary(df, evals, k=100)
    got = {r.run: r for r in summary.collect()}
    own = series(rows, "hot")
    assert got["hot"].min_loss == min(r[2] for r in own)
    best = min(r[2] * 4 for r in own if r[1] % 50 == 0)
    assert got["hot"].best_perplexity == pytest.approx(math.exp(min(best, 20)))
    assert got["hot"].throughput == pytest.approx(own[-1][4] / own[-1][3])
    text = {r.run: r.report for r in runs.summary_text(summary).collect()}["hot"]
    assert f"| min loss | {got['hot'].min_loss:.4f} |" in text and text.count("\n") == 8
    evals = evals.withColumn("val_perplexity", numbers.perplexity(F.col("val_loss")))
    samples = df.select("run", "step", F.lit("p").alias("prompt"), F.lit("t" * 400).alias("text"))
    full = {r.run: r.report for r in runs.summary_text(summary, evals, samples, last_evals=3).collect()}["hot"]
    steps = [r[1] for r in own]
    assert [int(x) for x in re.findall(r"^\| (\d+) \|", full, re.M)] == [s for s in steps if s % 50 == 0][-3:]
    assert re.findall(r"^step (\d+): p -> (t+)$", full, re.M) == [(str(s), "t" * 300) for s in steps[-5:]]


def test_best_point(spark):
    df = spark.createDataFrame([("a", 3, 2.0), ("a", 1, 1.0), ("a", 2, 1.0), ("a", 9, 4.0)], "run string, step long, val_loss double")
    assert tuple(runs.best_point(df).first()) == ("a", 1.0, 1, 4.0)
    gaps = spark.createDataFrame([("a", 1, 2.0), ("a", 2, None), ("a", 3, 1.0), ("a", 4, None)], "run string, step long, val_loss double")
    assert tuple(runs.best_point(gaps).first()) == ("a", 1.0, 3, 1.0)
    nothing = spark.createDataFrame([("a", 1, None)], "run string, step long, val_loss double")
    assert tuple(runs.best_point(nothing).first()) == ("a", None, None, None)


def test_rounding_of_logged_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1, 0.00000250, 1.00005, 2.25, inf, 7), (2, None, 2.5, -2.35, -inf, 8)], "step long, loss double, grad_norm double, elapsed_sec double, best_val_loss double, other int")
    got = [tuple(r) for r in df.select(*numbers.as_logged(df.columns)).orderBy("step").collect()]
    assert got == [(1, 0.000002, 1.0, 2.2, inf, 7), (2, None, 2.5, -2.4, -inf, 8)]


def test_formulas(spark):
    seconds = [0.0, 0.5, 1.5, 59.4, 60.0, 61.0, 75.0, 195.0, 3599.0, 3600.0, 26820.0, 360061.0]

    def words(s):
        if s < 60:
            return f"{s:.0f}s"
        return f"{s / 60:.1f}m" if s < 3600 else f"{int(s // 3600)}h{int(s % 3600 // 60)}m"

    df = spark.createDataFrame([(s,) for s in seconds], "s double")
    assert [r.d for r in df.select(numbers.format_duration(F.col("s")).alias("d")).collect()] == [words(s) for s in seconds]

    def rate(step):
        if step < 10:
            return 0.5 * (step + 1) / 10
        if step >= 50:
            return 0.1
        return 0.1 + 0.5 * (1 + math.cos(math.pi * (step - 10) / 40)) * 0.4

    got = spark.range(60).select(numbers.lr_schedule(F.col("id"), 10, 50, 0.5, 0.1).alias("lr")).collect()
    assert [r.lr for r in got] == [pytest.approx(rate(s)) for s in range(60)]
    capped = spark.range(1).select(numbers.perplexity(F.lit(99.0)).alias("p"), numbers.eta_seconds(F.lit(0), F.lit(1.0), 5).alias("e")).first()
    assert capped.p == pytest.approx(math.exp(20)) and capped.e is None
    est = spark.range(1).select(*[c.alias(n) for n, c in numbers.run_estimate(F.lit(1000.0), 10**9, 50).items()]).first()
    assert est.expected_throughput == 8000 and est.est_hours == pytest.approx(10**9 / 8000 / 3600) and est.status == "OK"


def test_a_report_has_the_whole_history(spark, ranges):
    log = spark.createDataFrame([("hot", s, 5.0 - s / 100, s * 2.0, s * 10) for s in range(1, 121)] + [("b", 1, 4.0, 2.0, 10)],
                                "run string, step long, loss double, elapsed_sec double, tokens_seen long")
    evals = log.select("run", "step", F.col("loss").alias("val_loss"), F.exp("loss").alias("val_perplexity")).where("run = 'hot'")
    samples = log.select("run", "step", F.lit("p").alias("prompt"), F.lit("t").alias("text"))
    summary = runs.run_summary(log, evals)
    text = {r.run: r.report for r in runs.summary_text(summary, evals, samples).collect()}
    assert [x.split()[1] for x in text["hot"].split("\n")[12:132]] == [str(s) for s in range(1, 121)]
    lines = sorted(runs.report_lines(summary, evals, samples).collect(), key=lambda r: (r.run, r.position))
    for run, report in text.items():
        own = [r for r in lines if r.run == run]
        assert [r.position for r in own] == list(range(len(own)))
        assert "\n".join(r.line for r in own) == report


def test_an_overlay_keeps_rows_without_an_evaluation(spark):
    log = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 1.5), ("b", 1, 3.0)], "run string, step long, loss double")
    evals = spark.createDataFrame([("a", 2, 1.0, 2.7), ("a", 3, 9.0, 9.0)], "run string, step long, val_loss double, val_perplexity double")
    got = runs.curve_overlay(log, evals).select("run", "step", "loss", "val_loss").collect()
    assert sorted(map(tuple, got)) == [("a", 1, 2.0, None), ("a", 2, 1.5, 1.0), ("b", 1, 3.0, None)]


def test_an_overlay_of_the_whole_table_has_all_evaluations(spark):
    import __spark_entry__ as entry

    got = entry.queries()["curve_overlay"](spark, "/root/testdata/sf0.001")
    assert got.where("val_loss is null").isEmpty() and not got.isEmpty()
