"""Encoding and packing of a document stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.functions.text import drop_blank
from loomframe.operators.joins import lookup
from loomframe.operators.packing import block_budget, spans, token_offsets
from loomframe.operators.tokens import ByteCarrier, Carrier, encode_bytes


def encode_stream(docs: DataFrame, order: str, text: str) -> DataFrame:
    """Non-blank documents as byte tokens; stateless, so it runs on batches and streams alike."""
    return drop_blank(docs, text).select(order, encode_bytes(F.col(text)).alias("tokens"))


class StreamPacker:
    """Packs a stream of token sequences into ``shard, block_id, chunk``, going on where the last micro-batch ended.

    A micro-batch is packed by the batch operators: lengths are sorted in key ranges whose token counts
    are carried, so one shard, or the one order of a stream without shards, is spread over as many
    tasks as it needs and none holds more than its share. What a micro-batch leaves over, fewer than
    ``block + 1`` tokens a shard, is a row of its own in the batch's folder and the first piece of the
    next one. A batch that is delivered again reads the same left-over and overwrites its own folder.

    Documents are taken in the order of their micro-batches, and by ``order``, unique in a shard, within
    one. Chunks hold ``block + 1`` tokens in the carrier's form; ``shift`` reads ``x`` and ``y`` off
    them. ``max_tokens`` is a budget per shard. Rows with a null shard or order are left out.
    """

    def __init__(
        self, path: str, order: str, tokens: Column, count: Column, carrier: Carrier, shard: Column | None = None,
        block: int = 1024, max_tokens: int | None = None,
    ):
        self.path, self.order, self.tokens, self.count, self.carrier = path, order, tokens, count, carrier
        self.shard = F.lit(0) if shard is None else shard
        self.block, self.limit = block, block_budget(block, max_tokens)
        kind = "binary" if isinstance(carrier, ByteCarrier) else "array<int>"
        self.schema = f"shard long, block_id long, chunk {kind}, done boolean"

    def _left_over(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The last, unfinished block of each shard after a batch."""
        if batch_id < 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/rows/batch={batch_id}").where("not done")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        left = self._left_over(batch.sparkSession, batch_id - 1)
        docs = batch.withColumn("shard", self.shard.cast("long")).where(F.col("shard").isNotNull() & F.col(self.order).isNotNull())
        total = docs.count()
        offsets = token_offsets(docs, self.order, self.count, ("shard",), total)
        # a batch counts its tokens and blocks from the left-over on, which begins block ``base``
        held = self.carrier.count(F.col("chunk")).alias("held")
        ends = left.select(F.col("shard").alias("__of"), F.col("block_id").alias("__base"), held)
        zero = F.lit(0).cast("long")
        offsets = lookup(offsets, ends, "shard", "__of", "left", rows=total).select(
            "shard", self.order, "n", (F.col("start") + F.coalesce("held", zero)).alias("start"), F.coalesce("__base", zero).alias("base")
        )
        if self.limit is not None:
            offsets = offsets.where(F.col("start") + F.col("base") * self.block <= self.limit * self.block)
        placed = docs.select("shard", self.order, self.tokens.alias("tokens")).join(offsets, ["shard", self.order])
        first = left.select("shard", F.col("block_id").alias("base"), F.col("chunk").alias("tokens"), held.alias("n"), zero.alias("start"))
        placed = placed.select("shard", "base", "tokens", "n", "start").unionByName(first)
        cut = spans(placed, self.carrier, self.block, 1, "at", ("shard", "base")).withColumn("block_id", F.col("base") + F.col("at"))
        done = self.carrier.count(F.col("chunk")) == self.block + 1
        if self.limit is not None:  # what follows the last block only says that the budget is spent
            cut, done = cut.where(F.col("block_id") <= self.limit), done & (F.col("block_id") < self.limit)
        cut.select("shard", "block_id", "chunk", done.alias("done")).write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")

    def run(self, stream: DataFrame) -> None:
        """Process everything that is there and stop; a second call resumes where the first one ended."""
        (
            stream.writeStream.foreachBatch(self).option("checkpointLocation", f"{self.path}/_progress")
            .trigger(availableNow=True).start().awaitTermination()
        )

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/rows/batch=*").where("done").drop("done")


def run_to_files(stream: DataFrame, path: str) -> None:
    """Process everything that is there and stop; a second call resumes where the first one ended."""
    (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/_progress")
        .option("path", f"{path}/rows").trigger(availableNow=True).start().awaitTermination()
    )
