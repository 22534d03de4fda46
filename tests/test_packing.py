import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomframe.functions.text import drop_blank
from loomframe.operators import packing, tokens
from loomframe.operators.tokens import BYTES, ArrayCarrier, decode_bytes, encode_bytes
from tests import models


def corpus(seed=5, n=40):
    rng = random.Random(seed)
    texts = [None, "", "   ", " 　", "\x1c", "x", "y" * 50]
    texts += ["".join(rng.choice("ab é\n") for _ in range(rng.randint(1, 30))) for _ in range(n)]
    rng.shuffle(texts)
    return texts


def table(spark, texts, partitions=3):
    return spark.createDataFrame([(i * 5, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(partitions)


def result(blocks):
    return [(r.x, r.y) for r in blocks.orderBy("block_id").collect()]


@pytest.mark.parametrize("block", [1, 2, 7, 64])
def test_pack_equals_a_sequential_pass(spark, ranges, block):
    texts = corpus()
    want = models.blocks(models.stream(texts), block)
    docs = drop_blank(table(spark, texts), "text")
    assert result(packing.pack_text(docs, "doc_id", "text", BYTES, block)) == want
    encoded = docs.select("doc_id", encode_bytes(F.col("text")).alias("tokens"))
    carrier = ArrayCarrier(models.END)
    tokens = F.col("tokens")
    assert result(packing.pack_blocks(encoded, "doc_id", tokens, carrier.count(tokens), carrier, block)) == want


@pytest.mark.parametrize("extra,blocks", [(0, 2), (1, 3), (2, 3)])
def test_exact_multiples(spark, extra, blocks):
    # 8 bytes per block: 3 * 8 tokens make two blocks, one more token makes three
    docs = table(spark, ["a" * (3 * 8 - 1 + extra)])
    assert packing.pack_text(docs, "doc_id", "text", BYTES, 8).count() == blocks


@pytest.mark.parametrize("budget", [None, 0, 1, 7, 8, 30, 10_000])
def test_budget_stops_after_the_block_that_reaches_it(spark, budget):
    texts = corpus(9)
    docs = drop_blank(table(spark, texts), "text")
    got = packing.pack_text(docs, "doc_id", "text", BYTES, 7, max_tokens=budget)
    assert result(got) == models.blocks(models.stream(texts), 7, budget)


@pytest.mark.parametrize("prefix", [1, 8, 9, 100, 10_000])
def test_prefix_is_cut_exactly(spark, ranges, prefix):
    texts = corpus(11)
    docs = drop_blank(table(spark, texts), "text")
    text = F.col("text")
    got = packing.prefix_blocks(
        docs, "doc_id", BYTES.concat(BYTES.from_text(text), BYTES.ending()), BYTES.text_count(text) + 1, BYTES, 8, prefix
    )
    assert result(got) == models.blocks(models.stream(texts)[:prefix], 8)


def test_groups_are_packed_on_their_own(spark, ranges):
    texts = corpus(13)
    docs = drop_blank(table(spark, texts), "text").withColumn("shard", F.col("doc_id") % 3)
    got = packing.pack_text(docs, "doc_id", "text", BYTES, 7, group=("shard",)).orderBy("block_id").collect()
    for shard in range(3):
        own = [t for i, t in enumerate(texts) if i * 5 % 3 == shard]
        assert [(r.x, r.y) for r in got if r.shard == shard] == models.blocks(models.stream(own), 7)


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_partition_count_does_not_matter(spark, tiny_ranges, partitions):
    texts = corpus(17)
    docs = drop_blank(table(spark, texts, partitions), "text")
    assert result(packing.pack_text(docs, "doc_id", "text", BYTES, 16)) == models.blocks(models.stream(texts), 16)


def test_bytes_come_back_as_text(spark):
    texts = ["Hello, world! This is a test.", "", "é\x00ÿ\U0001f600", None]
    docs = table(spark, texts).withColumn("ids", encode_bytes(F.col("text"))).withColumn("back", decode_bytes(F.col("ids")))
    for row in docs.collect():
        assert row.back == row.text
        assert row.ids == (None if row.text is None else [*row.text.encode(), 256])


def long_texts(spark):
    """One partition with 12 MB of text, which Spark sends in one batch."""
    return spark.range(0, 3_000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), 1_400).alias("text"))


def test_tokens_are_made_in_slices_of_bounded_size(spark, monkeypatch):
    made = long_texts(spark).withColumn("ids", encode_bytes(F.col("text")))
    assert made.agg(F.min(F.size("ids")), F.max(F.size("ids"))).first() == (4_201, 4_201)

    def held(column):
        return sum(len(v) for v in column.to_pylist())

    # in place of the conversions: how many values the slice of a row holds
    monkeypatch.setattr(tokens, "_bytes_to_ids", lambda column: pa.array([[held(column)]] * len(column), pa.list_(pa.int32())))
    assert long_texts(spark).agg(F.max(encode_bytes(F.col("text"))[0])).first()[0] <= (1 << 20) + 4_201
    monkeypatch.setattr(tokens, "_ids_to_bytes", lambda column: pa.array([b"%09d" % held(column)] * len(column), pa.binary()))
    ids = F.array_repeat(F.lit(97), 4_200)
    assert int(long_texts(spark).agg(F.max(decode_bytes(ids))).first()[0]) <= (1 << 20) + 4_200


def test_rows_of_any_size_are_sliced_without_loss():
    texts = [None, "", "x" * 30, "y", None, "z" * 9, ""]
    for column in (pa.array(texts), pa.array(texts).slice(2), *[pa.array([None if t is None else value(t) for t in texts]) for value in (lambda t: [t, t], lambda t: [1] * len(t))]):
        parts = list(tokens.slices(column, 10))
        assert [v for part in parts for v in part.to_pylist()] == column.to_pylist()
        assert len(parts) > 1 and all(len(part) for part in parts)
    assert not list(tokens.slices(pa.array([], pa.string())))
