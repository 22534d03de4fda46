import os
import random

import pytest
from pyspark.sql import functions as F

from loomframe.functions.text import drop_blank
from loomframe.operators.packing import shift
from loomframe.operators.runs import running_best, smooth_metric, step_throughput
from loomframe.operators.tokens import BYTES, ArrayCarrier, encode_bytes
from loomframe.sources.corpus import read_stream
from loomframe.streaming.metrics import ROW_SCHEMA, LiveMetrics
from loomframe.streaming.pack import StreamPacker, encode_stream, run_to_files
from tests import models

DOCS = "doc_id long, text string"


def add_file(spark, folder, name, rows, schema, age):
    """One parquet file per call; the stream takes files in the order of their time stamps."""
    staged = f"{os.path.dirname(folder)}/staged-{name}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(staged)
    part = next(f for f in os.listdir(staged) if f.endswith(".parquet"))
    os.makedirs(folder, exist_ok=True)
    target = f"{folder}/{name}.parquet"
    os.link(f"{staged}/{part}", target)
    os.utime(target, (1_700_000_000 + age, 1_700_000_000 + age))


def texts(n=60, seed=2):
    rng = random.Random(seed)
    return [rng.choice(["", " ", "".join(rng.choice("abcé ") for _ in range(rng.randint(1, 40)))]) for _ in range(n)]


def expected(docs, shards, block, budget=None):
    out = {}
    for shard in range(shards):
        own = models.stream(t for i, t in enumerate(docs) if i % shards == shard)
        for b, pair in enumerate(models.blocks(own, block, budget)):
            out[shard, b] = pair
    return out


@pytest.mark.parametrize("kind", ["bytes", "arrays"])
@pytest.mark.parametrize("budget, shards", [(None, 3), (40, 3), (None, 1), (100, 1)])
def test_stream_packs_like_a_batch_and_resumes(spark, tmp_path, tiny_ranges, kind, budget, shards):
    docs, folder, out = texts(), str(tmp_path / "in"), str(tmp_path / "out")
    carrier = BYTES if kind == "bytes" else ArrayCarrier(models.END)
    tokens = BYTES.concat(BYTES.from_text(F.col("text")), BYTES.ending()) if kind == "bytes" else F.col("ids")
    packer = StreamPacker(out, "doc_id", tokens, carrier.count(tokens), carrier, F.col("doc_id") % 3 if shards > 1 else None, 16, budget)

    def prepared(df):
        df = drop_blank(df, "text")
        return df if kind == "bytes" else df.withColumn("ids", encode_bytes(F.col("text")))

    rows = list(enumerate(docs))
    for name, part, age in (("a", rows[:25], 1), ("b", rows[25:30], 2), ("c", rows[30:], 3)):
        add_file(spark, folder, name, part, DOCS, age)
        packer.run(prepared(read_stream(spark, folder, spark.createDataFrame([], DOCS).schema)))
    packer(prepared(spark.createDataFrame(rows[30:], DOCS)), 2)  # a batch that is delivered again changes nothing
    done = shift(packer.blocks(spark), carrier, 16).collect()
    assert {(r.shard, r.block_id): (r.x, r.y) for r in done} == expected(docs, shards, 16, budget)
    assert len(done) == len({(r.shard, r.block_id) for r in done})


def test_a_shard_is_spread_over_tasks(spark, tmp_path, tiny_ranges):
    docs = [(k, "x" * 100) for k in range(400)]
    tokens = BYTES.concat(BYTES.from_text(F.col("text")), BYTES.ending())
    packer = StreamPacker(str(tmp_path / "out"), "doc_id", tokens, BYTES.count(tokens), BYTES, block=64)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        packer(spark.createDataFrame(docs, DOCS), 0)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = [f for f in os.listdir(f"{tmp_path}/out/rows/batch=0") if f.endswith(".parquet")]
    assert len(files) == 3  # as many as there are shuffle partitions
    assert packer.blocks(spark).count() == (400 * 101 - 1) // 64


def test_stream_encodes_like_a_batch(spark, tmp_path):
    docs, folder, out = texts(20), str(tmp_path / "in"), str(tmp_path / "out")
    add_file(spark, folder, "a", list(enumerate(docs)), DOCS, 1)
    run_to_files(encode_stream(read_stream(spark, folder, spark.createDataFrame([], DOCS).schema), "doc_id", "text"), out)
    got = {r.doc_id: r.tokens for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == {i: [*t.encode(), 256] for i, t in enumerate(docs) if t.strip()}


def test_live_metrics_equal_the_whole_log(spark, tmp_path, ranges):
    rng = random.Random(9)
    rows = [(run, s, round(rng.uniform(1, 5), 3), s * 2.0, s * 100) for s in range(40) for run in ("hot", "b") if run == "hot" or s % 9 == 0]
    folder, live = str(tmp_path / "in"), LiveMetrics(str(tmp_path / "out"), 100, width=5)
    schema = spark.createDataFrame([], ROW_SCHEMA).schema
    for name, part, age in (("a", rows[:20], 1), ("b", rows[20:22], 2), ("c", rows[22:], 3)):
        add_file(spark, folder, name, part, ROW_SCHEMA, age)
        live.run(read_stream(spark, folder, schema))
    log = spark.createDataFrame(rows, ROW_SCHEMA)
    whole = running_best(step_throughput(smooth_metric(log, width=5), 100), "loss")
    names = ["run", "step", "smooth_loss", "tokens_per_sec", "corrected"]
    want = sorted(tuple(r) for r in whole.select(*names, F.col("best_val_loss").alias("best_loss")).collect())
    got = sorted(tuple(r) for r in live.rows(spark).select(*names, "best_loss").collect())
    assert len(got) == len(rows) and all(g == pytest.approx(w) for g, w in zip([x[1:] for x in got], [x[1:] for x in want]))

    before = sorted(tuple(r) for r in live.rows(spark).collect())
    last = spark.createDataFrame(rows[22:], ROW_SCHEMA)
    live(last, 2)  # a batch that is delivered again changes nothing
    assert sorted(tuple(r) for r in live.rows(spark).collect()) == before


def test_a_batch_writes_the_state_of_its_own_runs(spark, tmp_path):
    live = LiveMetrics(str(tmp_path / "out"), 100, width=5)
    runs = [f"run {i}" for i in range(20)]

    def batch(number, names):
        rows = [(run, number * 3 + s, 1.0 + s, s * 2.0, s * 100) for run in names for s in range(3)]
        live(spark.createDataFrame(rows, ROW_SCHEMA), number)
        return len([f for f in os.listdir(f"{live.path}/state/{number}") if f.startswith("part=")])

    many = batch(0, runs)
    assert many > 10 and [batch(n, ["run 7"]) for n in (1, 2, 3)] == [1, 1, 1]
    assert len(os.listdir(f"{live.path}/index")) == 2  # and what no batch can ask for is gone
    assert not [f for f in os.listdir(f"{live.path}/state/1") if f.startswith("part=")]
    assert batch(4, ["run 3"]) == 1
    got = {(r.run, r.step): r.smooth_loss for r in live.rows(spark).where("run in ('run 3', 'run 7')").collect()}
    for run, numbers in (("run 7", (0, 1, 2, 3)), ("run 3", (0, 4))):
        losses = [(n * 3 + s, 1.0 + s) for n in numbers for s in range(3)]
        for i, (step, _) in enumerate(losses):
            part = [v for _, v in losses[max(0, i - 4) : i + 1]]
            assert got[run, step] == pytest.approx(sum(part) / len(part))
