"""Losses, filters and draws over scored or generated tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.numbers import INFINITY
from loomframe.operators.chat import IGNORED
from loomframe.operators.joins import lookup
from loomframe.operators.ordering import Running, running
from loomframe.session import cut_lineage

#: Buckets of scores in which :func:`nucleus` adds up masses, and how many of them a difference of 1 is.
SCORE_BUCKETS, SCORE_STEPS = 2048, 64


def masked_loss(scored: DataFrame, batch_size: int, max_batches: int | None = None) -> DataFrame:
    """Evaluation loss of ``seq, pos, label, nll`` over all batches, or the first ``max_batches``.

    ``loss`` averages the batch means, as evaluation reports it; ``token_loss`` weighs every token
    the same. A batch without any label has no mean, which makes the average not a number.
    """
    batch = F.call_function("div", F.col("seq"), F.lit(batch_size).cast("long"))
    counted = F.when(F.col("label") != IGNORED, F.col("nll"))
    if max_batches is not None:
        scored = scored.where(F.col("seq") < batch_size * max_batches)
    batches = (
        scored
        .groupBy(batch.alias("batch"))
        .agg(
            F.coalesce(F.avg(counted), F.lit(float("nan"))).alias("mean"),
            F.sum(counted).alias("total"),
            F.count(counted).alias("labels"),
        )
    )
    return batches.agg(
        F.coalesce(F.avg("mean"), F.lit(INFINITY)).alias("loss"),
        F.when(F.sum("labels") > 0, F.sum("total") / F.sum("labels")).otherwise(F.lit(INFINITY)).alias("token_loss"),
        F.count(F.lit(1)).alias("batches"),
    )


def label_coverage(examples: DataFrame, key: str, first: int | None = None) -> DataFrame:
    """Share of label positions that carry loss, over all examples or the ``first``."""
    rows = examples.select(key, F.size("labels").alias("n"),
                           F.size(F.filter("labels", lambda v: v != IGNORED)).alias("kept"))
    if first is not None:
        rows = rows.orderBy(key).limit(first)
    return rows.agg(F.sum("kept").alias("labels"), F.sum("n").alias("positions")).withColumn(
        "coverage", F.when(F.col("positions") > 0, F.col("labels") * 100.0 / F.col("positions"))
    )


def topk_ties(logits: DataFrame, k: int, ctx: str = "ctx_id", score: str = "logit") -> DataFrame:
    """The ``k`` best items of each context and whatever ties with the last of them."""
    best = Window.partitionBy(ctx).orderBy(F.col(score).desc())
    return logits.withColumn("__rank", F.rank().over(best)).where(F.col("__rank") <= k).drop("__rank")


def nucleus(logits: DataFrame, p: float, ctx: str = "ctx_id", item: str = "token_id", score: str = "logit",
            rows: int | None = None) -> DataFrame:
    """Keep the best items of each context until their probability exceeds ``p``.

    An item stays while the mass before it is at most ``p``, so the one that crosses the line stays.
    Equal scores go by item. Masses are added up per context and bucket of scores first: whole buckets
    stay or go by the mass before them, and only the items of the one bucket in which the line is
    crossed are put in order.
    """
    peaks = logits.groupBy(F.col(ctx).alias("__c")).agg(F.max(score).alias("__peak"))
    below = F.col("__peak") - F.col(score)
    bucket = F.floor(F.least(below * F.lit(float(SCORE_STEPS)), F.lit(float(SCORE_BUCKETS - 1)))).cast("int")
    weighted = cut_lineage(
        lookup(logits, peaks, ctx, "__c", rows=rows).withColumns({"__w": F.exp(-below), "__bucket": F.coalesce(bucket, F.lit(SCORE_BUCKETS))})
        .drop("__c", "__peak")
    )
    masses = weighted.groupBy(F.col(ctx).alias("__c"), F.col("__bucket").alias("__b")).agg(F.sum("__w").alias("__m"))
    down = Window.partitionBy("__c").orderBy("__b")  # at most SCORE_BUCKETS + 1 rows a context
    masses = masses.withColumns({
        "__mass": F.sum("__m").over(Window.partitionBy("__c")),
        "__start": F.coalesce(F.sum("__m").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
    }).where(F.col("__start") / F.col("__mass") <= p)
    last = masses.withColumn("__crossed", F.lead("__b").over(down).isNull())
    edge = cut_lineage(last.where("__crossed").select("__c", F.col("__b").alias("__edge"), "__start", "__mass"))
    near = cut_lineage(lookup(weighted, edge, ctx, "__c", rows=rows).where(F.col("__bucket") <= F.col("__edge")).drop("__c"))
    crossing = near.where(F.col("__bucket") == F.col("__edge")).withColumn("__down", -F.col(score))
    ordered = running(crossing, ["__down", item], {"__before": Running("sum", F.col("__w"), current=False)}, [ctx], rows)
    kept = near.where(F.col("__bucket") < F.col("__edge")).unionByName(
        ordered.where((F.col("__start") + F.col("__before")) / F.col("__mass") <= p).drop("__down", "__before")
    )
    return kept.select(*logits.columns, (F.col("__w") / F.col("__mass")).alias("prob"))


def unit_draw(*parts: Column, seed: int) -> Column:
    """A number in (0, 1) fixed by its parts and the seed, the same in any engine and on any rerun."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def weighted_draw(logits: DataFrame, temperature: float, seed: int, ctx: str = "ctx_id", item: str = "token_id",
                  score: str = "logit") -> DataFrame:
    """Draw one item per context with probability softmax(score / temperature).

    The largest score plus Gumbel noise is such a draw, so it is a plain maximum.
    """
    noise = -F.log(-F.log(unit_draw(F.col(ctx), F.col(item), seed=seed)))
    drawn = F.struct((F.col(score) / temperature + noise).alias("value"), (-F.col(item)).alias("item"))
    return logits.groupBy(ctx).agg(F.max(drawn).alias("best")).select(ctx, (-F.col("best.item")).alias(item))


def sample_items(logits: DataFrame, temperature: float, seed: int, k: int | None = None, p: float | None = None) -> DataFrame:
    """Temperature, then top-k, then nucleus over the survivors, then the draw."""
    scaled = logits.withColumn("logit", F.col("logit") / temperature)
    if k is not None:
        scaled = topk_ties(scaled, k)
    if p is not None:
        scaled = nucleus(scaled, p)
    return weighted_draw(scaled, 1.0, seed)


def trim_at_stop(df: DataFrame, tokens: str, stop: list[int], end: int) -> DataFrame:
    """Cut ``tokens`` before the first complete stop sequence or end-of-text, whichever is complete first."""
    n = F.size(tokens)
    # as text ",5,17,9," a sequence of whole tokens is found by a plain substring search
    spelled = F.concat(F.lit(","), F.array_join(F.col(tokens).cast("array<string>"), ","), F.lit(","))
    before = F.substring_index("__spelled", "," + ",".join(map(str, stop)) + ",", 1)
    found = F.length("__before") < F.length("__spelled")
    # every token before the hit is led by a comma
    stop_at = F.when(found, F.length("__before") - F.length(F.replace(F.col("__before"), F.lit(","), F.lit("")))).otherwise(n)
    end_at = F.coalesce(F.nullif(F.array_position(tokens, end), F.lit(0).cast("long")).cast("int") - 1, n)
    return (
        df.withColumn("__spelled", spelled)
        .withColumn("__before", before)
        .withColumns({"__stop": stop_at, "__end": end_at})
        .withColumn(tokens, F.slice(tokens, 1, F.when(F.col("__end") < F.col("__stop") + len(stop),
                                                      F.col("__end")).otherwise(F.col("__stop"))))
        .drop("__spelled", "__before", "__stop", "__end")
    )


def trim_text_at_stop(text: Column, stop: str) -> Column:
    return F.substring_index(text, stop, 1)


def keep_last(tokens: Column, n: int) -> Column:
    """The last ``n`` tokens."""
    return F.slice(tokens, F.greatest(F.lit(1), F.size(tokens) - n + 1), n)
