"""Scalar formulas of the run reports."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")
PERPLEXITY_CAP = 20.0


def perplexity(loss: Column) -> Column:
    return F.exp(F.least(loss, F.lit(PERPLEXITY_CAP)))


def safe_divide(top: Column, bottom: Column, default: Column | float | None = 0.0) -> Column:
    """``top / bottom`` where ``bottom`` is positive, else ``default``."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(default))


def format_duration(seconds: Column) -> Column:
    """``42s``, ``3.5m`` or ``7h27m``."""
    hours = F.floor(seconds / 3600)
    minutes = F.floor(F.pmod(seconds, F.lit(3600.0)) / 60)
    return (
        F.when(seconds < 60, F.format_string("%.0fs", F.bround(seconds, 0)))
        .when(seconds < 3600, F.format_string("%.1fm", F.bround(seconds / 60, 1)))
        .otherwise(F.format_string("%dh%dm", hours, minutes))
    )


# Digits that logs keep of each column; columns that are not listed are kept whole.
LOGGED_DIGITS = {
    "loss": 6, "smooth_loss": 6, "val_loss": 6, "best_val_loss": 6, "val_perplexity": 4, "grad_norm": 4,
    "vram_used_gb": 2, "vram_peak_gb": 2, "tokens_per_sec": 1, "elapsed_sec": 1,
}


def as_logged(columns: list[str], digits: dict[str, int] | None = None) -> list[Column]:
    """Columns rounded as logs print them, ties to even; infinite values and numbers that are none stay."""
    digits = LOGGED_DIGITS if digits is None else digits

    def value(name: str) -> Column:
        finite = F.abs(F.col(name)) < INFINITY
        return F.when(finite, F.bround(name, digits[name])).otherwise(F.col(name)).alias(name) if name in digits else F.col(name)

    return [value(name) for name in columns]


def lr_schedule(step: Column, warmup: int, max_steps: int, peak: float, floor: float) -> Column:
    """Linear warm-up, cosine decay to ``floor``, then ``floor``."""
    decayed = (step - warmup) / F.lit(float(max(max_steps - warmup, 1)))
    cosine = (F.cos(decayed * math.pi) + 1.0) * 0.5
    return (
        F.when(step < warmup, (step + 1) * peak / F.lit(float(max(warmup, 1))))
        .when(step >= max_steps, F.lit(floor))
        .otherwise(cosine * (peak - floor) + floor)
    )


def eta_seconds(step: Column, elapsed: Column, total_steps: int) -> Column:
    """Remaining seconds at the average pace so far; null before the first step."""
    return F.when(step > 0, (F.lit(total_steps) - step) * elapsed / step)


def nominal_tokens(steps: Column, micro_batch: int, accumulation: int, block: int = 1024) -> Column:
    """Tokens a run is said to have seen: padding counts."""
    return steps.cast("long") * (micro_batch * accumulation * block)


def run_estimate(throughput: Column, total_tokens: int, batch: int, test_batch: int = 4, cap: float = 8.0) -> dict[str, Column]:
    """Expected throughput, hours and verdict from the throughput of a small test run."""
    expected = throughput * min(batch / test_batch, cap)
    hours = F.when(throughput > 0, F.lit(float(total_tokens)) / expected / 3600.0)
    status = F.when(hours <= 30, "GOOD").when(hours <= 48, "OK").otherwise("SLOW")
    return {"expected_throughput": expected, "est_hours": hours, "status": status}


def epoch_plan(batch: Column, accumulation: int, steps_per_epoch: int) -> dict[str, Column]:
    """Optimizer step and epoch of a micro-batch."""
    step = F.call_function("div", batch, F.lit(accumulation).cast("long"))
    return {"step": step, "epoch": F.call_function("div", step, F.lit(max(steps_per_epoch, 1)).cast("long"))}
