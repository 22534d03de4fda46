"""Curves and summaries of training logs, one series per ``run`` ordered by ``step``.

A run may be most of the log, so nothing here windows a whole run in one task: positions come from
``row_index``, sliding frames from ``trailing``, and everything else is an aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.numbers import INFINITY, format_duration, perplexity, safe_divide
from loomframe.operators.joins import lookup
from loomframe.operators.ordering import Running, row_index, running, trailing
from loomframe.session import cut_lineage

RUN, STEP = "run", "step"
#: Values from here on are not averaged by running sums.
LARGEST = 1e15
POSITION = _POS = "__pos"


def in_order(log: DataFrame, order: Sequence[str] = (STEP,), rows: int | None = None) -> DataFrame:
    """Number the rows of each run once, so that several measures see rows of one step in one order.

    ``smooth_metric`` and ``step_throughput`` take and keep these numbers; ``POSITION`` orders the others.
    """
    return row_index(log, order, _POS, [RUN], rows)


def _series(log: DataFrame, values: dict[str, Column], width: int, order: Sequence[str], rows: int | None) -> DataFrame:
    numbered = _POS in log.columns
    series = trailing(log if numbered else in_order(log, order, rows), _POS, width, values, [RUN])
    return series if numbered else series.drop(_POS)


def smooth_metric(log: DataFrame, metric: str = "loss", width: int = 100, name: str = "smooth_loss",
                  order: Sequence[str] = (STEP,), rows: int | None = None) -> DataFrame:
    """Mean of the last ``width`` logged values."""
    return _series(log, {name: F.avg(metric)}, width, order, rows)


def step_throughput(log: DataFrame, tokens_per_step: int, order: Sequence[str] = (STEP,),
                    rows: int | None = None) -> DataFrame:
    """Tokens per second between logged rows.

    ``tokens_per_sec`` is what the log prints: the tokens of one step over the time since the row
    before, which may be many steps ago. ``corrected`` divides the tokens actually seen in between.
    """
    before = {"__t": F.first("elapsed_sec"), "__seen": F.first("tokens_seen")}
    paired = _series(log, before, 2, order, rows)
    gap = F.col("elapsed_sec") - F.col("__t")  # zero on the first row, which is its own predecessor
    return paired.withColumns(
        {
            "tokens_per_sec": safe_divide(F.lit(float(tokens_per_step)), gap),
            "corrected": safe_divide((F.col("tokens_seen") - F.col("__seen")).cast("double"), gap),
        }
    ).drop("__t", "__seen")


def adaptive_smooth(log: DataFrame, metric: str = "grad_norm", max_window: int = 50, divisor: int = 4,
                    min_rows: int = 10, order: Sequence[str] = (STEP,), rows: int | None = None) -> DataFrame:
    """Smooth with a window that grows with the series: ``min(max_window, n // divisor)`` rows before.

    Rows without a value are left out and the others keep their own step. Series of ``min_rows`` or
    fewer values are not smoothed. A mean is the difference of two running sums, so a row stays as wide
    as it is whatever the window; sums are exact to 1e-6 and carry the rest as doubles. A window with a
    value that is not finite or of ``LARGEST`` or more has no mean (not a number).
    """
    value = F.col(metric).cast("double")
    sound = F.when(F.abs(value) < F.lit(LARGEST), value)
    high = F.coalesce(sound, F.lit(0.0)).cast("decimal(28,6)")  # summed exactly; what is left is below 1e-6
    known = log.where(value.isNotNull()).withColumns(
        {"__high": high, "__low": F.coalesce(sound, F.lit(0.0)) - high.cast("double"), "__odd": F.when(sound.isNull(), value)}
    )
    sums = {
        _POS: Running("sum", F.lit(1).cast("long"), current=False), "__highs": Running("sum", F.col("__high")),
        "__lows": Running("sum", F.col("__low")), "__odds": Running("sum", F.col("__odd").isNotNull().cast("long")),
    }
    summed = cut_lineage(running(known, order, sums, [RUN], rows).drop("__high", "__low", "__odd"))
    sizes = summed.groupBy(F.col(RUN).alias("__run")).agg(F.count(F.lit(1)).alias("__n"))
    window = F.least(F.lit(max_window).cast("long"), F.call_function("div", F.col("__n"), F.lit(divisor).cast("long")))
    sized = lookup(summed, sizes, RUN, "__run", rows=rows).withColumn("__window", F.when(F.col("__n") > min_rows, window))
    # the sums up to the row before the window stand one window further on
    before = sized.select(
        F.col(RUN).alias("__run"), (F.col(_POS) + F.col("__window") + 1).alias("__at"),
        *[F.col(c).alias(f"{c}_before") for c in ("__highs", "__lows", "__odds")],
    )
    paired = sized.drop("__run").join(before, (F.col(RUN) == F.col("__run")) & (F.col(_POS) == F.col("__at")), "left")

    def within(name: str) -> Column:
        return F.col(name) - F.coalesce(F.col(f"{name}_before"), F.lit(0))

    taken = F.least(F.col(_POS), F.col("__window")) + 1
    mean = (within("__highs").cast("double") + within("__lows")) / taken
    mean = F.when(within("__odds") > 0, F.lit(float("nan"))).otherwise(mean)
    return paired.select(*log.columns, F.when(F.col("__window") > 1, mean).alias("smoothed"))


def running_best(evals: DataFrame, metric: str = "val_loss", order: Sequence[str] = (STEP,),
                 rows: int | None = None) -> DataFrame:
    """Best value before each evaluation, infinity at the first, and whether the row beats it."""
    best = running(evals, order, {"best_val_loss": Running("min", F.col(metric), current=False)}, [RUN], rows)
    known = F.coalesce("best_val_loss", F.lit(INFINITY))
    return best.withColumns({"best_val_loss": known, "is_best": F.col(metric) < known})


def attempts(log: DataFrame, order: Sequence[str], rows: int | None = None) -> DataFrame:
    """Number the attempts of a run: a new one starts where the clock falls back."""
    paired = _series(log, {"__t": F.first("elapsed_sec")}, 2, order, rows)
    restarted = F.when(F.col("elapsed_sec") < F.col("__t"), 1).otherwise(0).cast("long")
    return running(paired, order, {"attempt_id": Running("sum", restarted)}, [RUN], rows).drop("__t")


def head_tail(log: DataFrame, metric: str = "loss", k: int = 100, order: str = STEP) -> DataFrame:
    """Mean of the first and of the last ``k`` rows of each run.

    Both row numbers are filtered at once, so each map task forwards at most ``k`` rows per run.
    The values are added in step order: a run shorter than ``k`` has the same mean at both ends.
    """
    in_order = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(metric).alias("value"))))
    mean = F.aggregate(in_order, F.lit(0.0), lambda total, row: total + row["value"]) / F.count(F.lit(1))

    def edge(direction: Column, name: str) -> DataFrame:
        ranked = log.select(RUN, order, metric).where(F.col(metric).isNotNull()).withColumn(
            "__rn", F.row_number().over(Window.partitionBy(RUN).orderBy(direction))
        )
        return ranked.where(F.col("__rn") <= k).groupBy(RUN).agg(mean.alias(name))

    return edge(F.col(order).asc(), "head_mean").join(edge(F.col(order).desc(), "tail_mean"), RUN)


def trend_check(log: DataFrame, metric: str = "loss", k: int = 10) -> DataFrame:
    """Did the mean of the last ``k`` rows fall below that of the first ``k``?"""
    return head_tail(log, metric, k).withColumn("improved", F.col("tail_mean") < F.col("head_mean"))


def best_point(log: DataFrame, metric: str = "val_loss") -> DataFrame:
    """Lowest value, the step that first reached it, and the last value there is."""
    return log.groupBy(RUN).agg(
        F.min(metric).alias("best"),
        F.min_by(STEP, F.when(F.col(metric).isNotNull(), F.struct(metric, STEP))).alias("best_step"),
        F.max_by(metric, F.when(F.col(metric).isNotNull(), F.col(STEP))).alias("last"),
    )


def avg_throughput(log: DataFrame) -> DataFrame:
    return log.groupBy(RUN).agg(F.max("tokens_seen").alias("tokens"), F.max("elapsed_sec").alias("seconds")).withColumn(
        "throughput", safe_divide(F.col("tokens").cast("double"), F.col("seconds"))
    )


def microbatch_rollup(losses: DataFrame, k: int, keys: Sequence[str] = (RUN,)) -> DataFrame:
    """Step loss as the mean of ``k`` micro-batches; an incomplete last step is dropped."""
    step = F.call_function("div", F.col("batch_idx"), F.lit(k).cast("long"))
    return (
        losses.groupBy(*keys, step.alias(STEP))
        .agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") == k)
        .drop("__n")
    )


def interval_rows(log: DataFrame, every: int, skip_zero: bool = False) -> DataFrame:
    due = F.col(STEP) % every == 0
    return log.where(due & (F.col(STEP) > 0) if skip_zero else due)


def prompt_rotation(log: DataFrame, prompts: Sequence[str], every: int) -> DataFrame:
    """The prompt whose turn it is at each sampling step."""
    turn = F.call_function("div", F.col(STEP).cast("long"), F.lit(every).cast("long")) % len(prompts)
    return interval_rows(log, every, skip_zero=True).withColumn(
        "prompt", F.element_at(F.array(*[F.lit(p) for p in prompts]), (turn + 1).cast("int"))
    )


def curve_overlay(train: DataFrame, evals: DataFrame) -> DataFrame:
    """Training rows with the evaluation made at the same step, where there is one."""
    return train.join(evals.select(RUN, STEP, "val_loss", "val_perplexity"), [RUN, STEP], "left")


def curve_downsample(log: DataFrame, metric: str = "loss", points: int = 50, width: int = 40,
                     order: Sequence[str] = (STEP,), rows: int | None = None) -> DataFrame:
    """At most ``points`` evenly strided rows per run and the length of a text bar for each."""
    indexed = row_index(log.select(RUN, *order, metric), order, _POS, [RUN], rows)
    sizes = log.groupBy(F.col(RUN).alias("__run")).agg(F.count(F.lit(1)).alias("__n"))
    sized = lookup(indexed, sizes, RUN, "__run", rows=rows)
    kept = F.least(F.lit(points).cast("long"), F.col("__n"))
    stride = F.call_function("div", F.col("__n"), kept)
    sampled = sized.where((F.col(_POS) % stride == 0) & (F.call_function("div", F.col(_POS), stride) < kept))
    # at most ``points`` rows per run are left
    run = Window.partitionBy(RUN)
    low, high = F.min(metric).over(run), F.max(metric).over(run)
    bar = F.when(high > low, F.floor((F.col(metric) - low) / (high - low) * width)).otherwise(F.lit(width // 2))
    return sampled.withColumn("bar", bar.cast("long")).drop("__run", "__n", _POS)


def run_summary(train: DataFrame, evals: DataFrame, k: int = 100) -> DataFrame:
    """One row per run: loss at both ends, best values, throughput and duration."""
    ends = head_tail(train, "loss", k)
    low = train.groupBy(RUN).agg(F.min("loss").alias("min_loss"))
    best = evals.groupBy(RUN).agg(F.min("val_loss").alias("best_val_loss"))
    return (
        ends.join(low, RUN)
        .join(avg_throughput(train), RUN)
        .join(best, RUN, "left")
        .withColumns({"best_perplexity": perplexity(F.col("best_val_loss")), "duration": format_duration(F.col("seconds"))})
    )


#: Figures of a report in order, and the digits they are shown with.
_FIGURES = {
    "head_mean": 4, "tail_mean": 4, "min_loss": 4, "best_val_loss": 4, "best_perplexity": 2, "throughput": 0, "duration": None,
}


def _shown(name: str, digits: int | None) -> Column:
    if digits is None:
        return F.col(name).cast("string")
    return F.format_string(f"%.{digits}f", F.bround(F.col(name).cast("double"), digits))


def _table(columns: Sequence[str], rows: Column) -> Column:
    head = [F.lit(f"| {' | '.join(c.replace('_', ' ') for c in columns)} |"), F.lit("|" + "---|" * len(columns))]
    return F.concat_ws("\n", *head, rows)


def summary_text(summary: DataFrame, evals: DataFrame | None = None, samples: DataFrame | None = None,
                 last_evals: int | None = None, last_samples: int = 5, sample_chars: int = 300) -> DataFrame:
    """``run, report``: the summary as Markdown, with the evaluations and the last samples of each run.

    Labels are the column names. A report shows all evaluations, or the last ``last_evals``, and at
    most ``last_samples`` samples (``run, step, prompt, text``), newest last; row numbers are limited
    before the shuffle. A report is one string: :func:`report_lines` has a run of any length as rows.
    """
    lines = [F.format_string("| %s | %s |", F.lit(n.replace("_", " ")), F.coalesce(_shown(n, d), F.lit("-"))) for n, d in _FIGURES.items()]
    report = summary.select(RUN, _table(["metric", "value"], F.concat_ws("\n", *lines)).alias("report"))

    def latest(df: DataFrame, n: int | None, line: Column) -> DataFrame:
        newest = df
        if n is not None:
            newest = df.withColumn("__rn", F.row_number().over(Window.partitionBy(RUN).orderBy(F.col(STEP).desc()))).where(F.col("__rn") <= n)
        in_order = F.array_sort(F.collect_list(F.struct(F.col(STEP).alias("step"), line.alias("line"))))
        return newest.groupBy(RUN).agg(F.concat_ws("\n", F.transform(in_order, lambda x: x["line"])).alias("__lines"))

    if evals is not None:
        line = F.concat(F.lit("| "), F.concat_ws(" | ", F.col(STEP).cast("string"), _shown("val_loss", 4), _shown("val_perplexity", 2)), F.lit(" |"))
        history = latest(evals, last_evals, line).select(RUN, _table(["step", "val_loss", "val_perplexity"], F.col("__lines")).alias("__evals"))
        report = report.join(history, RUN, "left").select(RUN, F.concat_ws("\n\n", "report", "__evals").alias("report"))
    if samples is not None:
        line = F.concat(F.lit("step "), F.col(STEP).cast("string"), F.lit(": "), F.col("prompt"), F.lit(" -> "), F.substring("text", 1, sample_chars))
        told = latest(samples, last_samples, line).select(RUN, F.col("__lines").alias("__samples"))
        report = report.join(told, RUN, "left").select(RUN, F.concat_ws("\n\n", "report", "__samples").alias("report"))
    return report


def report_lines(summary: DataFrame, evals: DataFrame, samples: DataFrame | None = None, last_samples: int = 5,
                 sample_chars: int = 300, rows: int | None = None) -> DataFrame:
    """``run, position, line``: the report of :func:`summary_text` as ordered rows, with all evaluations.

    ``rows`` is an upper bound on the number of evaluations where the caller knows one.
    """
    short = summary_text(summary).select(RUN, F.posexplode(F.split("report", "\n")).alias("position", "line"))
    parts = [short.withColumn("position", F.col("position").cast("long"))]
    head = 2 + len(_FIGURES)
    sizes = evals.groupBy(RUN).agg(F.count(F.lit(1)).alias("__n")).join(summary.select(RUN), RUN)
    title = F.split(_table(["step", "val_loss", "val_perplexity"], F.lit(None).cast("string")), "\n")
    begin = sizes.select(RUN, F.posexplode(F.concat(F.array(F.lit("")), title)).alias("position", "line"))
    parts.append(begin.withColumn("position", F.col("position").cast("long") + head))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", F.col(STEP).cast("string"), _shown("val_loss", 4), _shown("val_perplexity", 2)), F.lit(" |"))
    known = evals.select(RUN, STEP, line.alias("line")).join(summary.select(RUN), RUN, "left_semi")
    parts.append(row_index(known, [STEP], "position", [RUN], rows).select(RUN, F.col("position") + head + 3, "line"))
    if samples is not None:
        newest = samples.withColumn("__rn", F.row_number().over(Window.partitionBy(RUN).orderBy(F.col(STEP).desc()))).where(F.col("__rn") <= last_samples)
        text = F.concat(F.lit("step "), F.col(STEP).cast("string"), F.lit(": "), F.col("prompt"), F.lit(" -> "), F.substring("text", 1, sample_chars))
        told = newest.groupBy(RUN).agg(F.array_sort(F.collect_list(F.struct(F.col(STEP).alias("step"), text.alias("line")))).alias("__told"))
        after = summary.select(RUN).join(told, RUN).join(sizes, RUN, "left")
        start = F.lit(head).cast("long") + F.coalesce(F.col("__n") + 3, F.lit(0).cast("long"))
        told_lines = F.concat(F.array(F.lit("")), F.transform("__told", lambda x: x["line"]))
        placed = after.select(RUN, start.alias("__start"), F.posexplode(told_lines).alias("position", "line"))
        parts.append(placed.select(RUN, (F.col("__start") + F.col("position")).alias("position"), "line"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part.toDF(RUN, "position", "line"))
    return whole
