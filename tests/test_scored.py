import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from loomframe.operators import scored

LOGITS = "ctx_id long, token_id int, logit double"


def logits(spark, seed=4, contexts=6, items=12):
    rng = random.Random(seed)
    rows = [(c, t, round(rng.uniform(-2, 2), 1)) for c in range(contexts) for t in range(items)]
    return spark.createDataFrame(rows, LOGITS).repartition(3), rows


def by_context(rows):
    out = collections.defaultdict(list)
    for ctx, item, value in rows:
        out[ctx].append((value, item))
    return out


@pytest.mark.parametrize("k", [1, 3, 100])
def test_topk_keeps_ties(spark, k):
    df, rows = logits(spark)
    want = set()
    for ctx, items in by_context(rows).items():
        values = sorted((v for v, _ in items), reverse=True)
        want |= {(ctx, i) for v, i in items if v >= values[min(k, len(values)) - 1]}
    assert {(r.ctx_id, r.token_id) for r in scored.topk_ties(df, k).collect()} == want


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
def test_nucleus_keeps_the_item_that_crosses(spark, ranges, p):
    df, rows = logits(spark)
    want = set()
    for ctx, items in by_context(rows).items():
        mass, before = sum(math.exp(v) for v, _ in items), 0.0
        for value, item in sorted(items, key=lambda e: (-e[0], e[1])):
            if before / mass <= p:
                want.add((ctx, item))
            before += math.exp(value)
    got = scored.nucleus(df, p).collect()
    assert {(r.ctx_id, r.token_id) for r in got} == want
    assert all(0 < r.prob <= 1 for r in got)


@pytest.mark.parametrize("p", [0.0, 0.3, 0.9])
def test_nucleus_of_tied_and_far_scores(spark, ranges, p):
    rows = [(0, t, 1.0) for t in range(40)] + [(0, 100 + t, -t * 10.0) for t in range(20)] + [(1, 5, -1000.0), (1, 6, -1000.0), (2, 1, 3.0)]
    want = set()
    for ctx, items in by_context(rows).items():
        peak = max(v for v, _ in items)
        mass, before = math.fsum(math.exp(v - peak) for v, _ in items), 0.0
        for value, item in sorted(items, key=lambda e: (-e[0], e[1])):
            if before / mass <= p:
                want.add((ctx, item))
            before += math.exp(value - peak)
    got = scored.nucleus(spark.createDataFrame(rows, LOGITS).repartition(3), p).collect()
    assert {(r.ctx_id, r.token_id) for r in got} == want


def test_nucleus_puts_only_the_crossing_bucket_in_order(spark, monkeypatch):
    seen = []

    def counted(df, *args, **more):
        seen.append(df.count())
        return running(df, *args, **more)

    running = scored.running
    monkeypatch.setattr(scored, "running", counted)
    rows = [(c, t, -t / 10) for c in range(3) for t in range(500)]
    assert not scored.nucleus(spark.createDataFrame(rows, LOGITS), 0.9).isEmpty()
    assert seen == [3]


def test_draws_follow_the_weights_and_repeat(spark):
    rows = [(c, t, math.log(w)) for c in range(4000) for t, w in enumerate((0.6, 0.3, 0.1))]
    df = spark.createDataFrame(rows, LOGITS)
    drawn = scored.weighted_draw(df, 1.0, seed=3)
    share = collections.Counter(r.token_id for r in drawn.collect())
    for item, weight in enumerate((0.6, 0.3, 0.1)):
        assert share[item] / 4000 == pytest.approx(weight, abs=0.03)
    again = scored.weighted_draw(df.repartition(7), 1.0, seed=3)
    assert drawn.exceptAll(again).isEmpty()
    cold = scored.weighted_draw(df, 0.01, seed=3)
    assert {r.token_id for r in cold.collect()} == {0}


def test_masked_loss(spark):
    rows = [(0, 0, 5, 1.0), (0, 1, -1, 9.0), (1, 0, 6, 3.0), (2, 0, 7, 8.0), (9, 0, 1, 100.0)]
    df = spark.createDataFrame(rows, "seq long, pos int, label int, nll double")
    got = scored.masked_loss(df, batch_size=2, max_batches=2).first()
    assert (got.loss, got.token_loss, got.batches) == (5.0, 4.0, 2)
    assert scored.masked_loss(df.where("seq > 100"), 2).first().loss == math.inf
    assert math.isnan(scored.masked_loss(df.where("seq = 0").withColumn("label", F.lit(-1)), 2).first().loss)


@pytest.mark.parametrize(
    "tokens,want",
    [
        ([7, 8, 1, 2], []), ([1, 7, 8, 2], [1]), ([1, 2, 7, 8], [1, 2]), ([1, 7, 2], [1, 7, 2]), ([1, 9, 7, 8], [1]),
        ([1, 7, 9], [1, 7]), ([7, 7, 8], [7]), ([17, 8, 3], [17, 8, 3]), ([], []), ([7, 8, 9], []), ([78, 7, 8], [78]),
    ],
)
def test_trim_at_stop(spark, tokens, want):
    df = spark.createDataFrame([(tokens,)], "t array<int>")
    assert scored.trim_at_stop(df, "t", [7, 8], end=9).first().t == want


def test_text_stop_and_keep_last(spark):
    df = spark.createDataFrame([([1, 2, 3], "a<e>b<e>"), ([], "none")], "t array<int>, s string")
    got = df.select(scored.keep_last(F.col("t"), 2).alias("t"), scored.trim_text_at_stop(F.col("s"), "<e>").alias("s")).collect()
    assert [(r.t, r.s) for r in got] == [([2, 3], "a"), ([], "none")]


def test_filters_compose(spark):
    df, _ = logits(spark)
    drawn = scored.sample_items(df, 0.8, seed=1, k=5, p=0.9)
    kept = scored.topk_ties(df, 5).select("ctx_id", "token_id")
    assert drawn.count() == 6 and drawn.exceptAll(kept).isEmpty()


def test_label_coverage(spark):
    df = spark.createDataFrame([(i, [-1, 4, -1, 5] if i < 3 else [1, 1, 1, 1]) for i in range(5)], "id long, labels array<int>")
    got = scored.label_coverage(df, "id", first=3).first()
    assert (got.labels, got.positions, got.coverage) == (6, 12, 50.0)
