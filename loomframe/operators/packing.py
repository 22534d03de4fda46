"""Packing a corpus into overlapping fixed-length next-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.ordering import Running, key_text, literal, running
from loomframe.operators.tokens import Carrier
from loomframe.session import cut_lineage


def whole(value: Column, size: int) -> Column:
    """Integer division, without a detour through doubles."""
    return F.call_function("div", value, F.lit(size).cast("long"))


def token_offsets(
    docs: DataFrame, order: str, count: Column, group: tuple[str, ...] = (), rows: int | None = None
) -> DataFrame:
    """``order, n, start``: length and position of each document in the corpus-wide token stream."""
    lengths = docs.select(*group, order, count.cast("long").alias("n"))
    return running(lengths, [order], {"start": Running("sum", F.col("n"), current=False)}, group, rows)


def within(offsets: DataFrame, docs: DataFrame, order: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """Offsets before token ``limit``, and the documents up to the last of these.

    The last key enters the plan as a literal, so the scan of the texts stops there.
    """
    used = cut_lineage(offsets.where((F.col("start") < limit) & (F.col("n") > 0)))
    kind = docs.schema[order].dataType
    last = used.agg(F.max(order).alias(order)).select(key_text(order, kind)).first()[0]
    return used, docs.where(F.col(order) <= F.expr(literal(last, kind)))


def place(
    docs: DataFrame, order: str, tokens: Column, count: Column, group: tuple[str, ...] = (), rows: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Documents with their place in the stream.

    Offsets are worked out on the narrow table and joined back, so only lengths are sorted. Whether
    they are small enough to be broadcast is for Spark to say. With ``limit``, only documents that
    begin before that many tokens are read.
    """
    offsets = token_offsets(docs, order, count, group, rows)
    if limit is not None and not group:
        offsets, docs = within(offsets, docs, order, limit)
    return docs.select(*group, order, tokens.alias("tokens")).join(offsets, [*group, order])


def spans(
    placed: DataFrame, carrier: Carrier, width: int, overlap: int, name: str, group: tuple[str, ...] = (),
    limit: int | None = None,
) -> DataFrame:
    """Cut the token stream every ``width`` tokens: ``name, chunk``.

    Each span also takes the ``overlap`` tokens that follow it. A document contributes one piece
    to every span it touches, so no row and no group exceeds a span.
    """
    first = F.greatest(whole(F.col("start") - overlap, width), F.lit(0).cast("long"))
    last = whole(F.col("start") + F.col("n") - 1, width)
    if limit is not None:
        last = F.least(last, F.lit(limit - 1).cast("long"))
    begin = F.col(name) * width
    lo = F.greatest(F.col("start"), begin)
    hi = F.least(F.col("start") + F.col("n"), begin + width + overlap)
    pieces = (
        placed.where((F.col("n") > 0) & (first <= last))
        .withColumn(name, F.explode(F.sequence(first, last)))
        .select(
            *group, name, lo.alias("lo"), carrier.cut(F.col("tokens"), lo - F.col("start"), hi - lo).alias("piece")
        )
    )
    joined = carrier.join(F.transform(F.array_sort(F.collect_list(F.struct("lo", "piece"))), lambda p: p["piece"]))
    return pieces.groupBy(*group, name).agg(joined.alias("chunk"))


def cut_blocks(
    placed: DataFrame, carrier: Carrier, block: int, limit: int | None = None, group: tuple[str, ...] = ()
) -> DataFrame:
    """``block_id, chunk`` with ``block + 1`` tokens each; neighbours share one token, the tail is dropped."""
    return spans(placed, carrier, block, 1, "block_id", group, limit).where(
        carrier.count(F.col("chunk")) == block + 1
    )


def block_budget(block: int, max_tokens: int | None) -> int | None:
    """Blocks needed to reach the budget; ``None`` and 0 mean no budget."""
    return -(-max_tokens // block) if max_tokens else None


def shift(blocks: DataFrame, carrier: Carrier, block: int) -> DataFrame:
    """Chunks to input ``x`` and next-token target ``y``."""
    ids = blocks.withColumn("chunk", carrier.ids(F.col("chunk")))
    return ids.withColumns({"x": F.slice("chunk", 1, block), "y": F.slice("chunk", 2, block)}).drop("chunk")


def pack_blocks(
    docs: DataFrame,
    order: str,
    tokens: Column,
    count: Column,
    carrier: Carrier,
    block: int = 1024,
    max_tokens: int | None = None,
    group: tuple[str, ...] = (),
    rows: int | None = None,
) -> DataFrame:
    """Token sequences (separator included) to ``block_id, x, y``."""
    blocks = block_budget(block, max_tokens)
    placed = place(docs, order, tokens, count, group, rows, blocks * block + 1 if blocks is not None else None)
    return shift(cut_blocks(placed, carrier, block, blocks, group), carrier, block)


def pack_text(
    docs: DataFrame, order: str, text: str, carrier: Carrier, block: int = 1024, max_tokens: int | None = None,
    group: tuple[str, ...] = (), rows: int | None = None,
) -> DataFrame:
    """Blocks straight from text, for carriers that encode inside an expression."""
    tokens = carrier.concat(carrier.from_text(F.col(text)), carrier.ending())
    return pack_blocks(
        docs, order, tokens, carrier.text_count(F.col(text)) + 1, carrier, block, max_tokens, group, rows
    )


def prefix_blocks(
    docs: DataFrame, order: str, tokens: Column, count: Column, carrier: Carrier, block: int, num_tokens: int,
    rows: int | None = None,
) -> DataFrame:
    """Blocks of the first ``num_tokens`` tokens, the stream being cut exactly there."""
    offsets, docs = within(token_offsets(docs, order, count, rows=rows), docs, order, num_tokens)
    offsets = offsets.withColumn("n", F.least(F.col("n"), F.lit(num_tokens) - F.col("start")))
    placed = docs.select(order, tokens.alias("tokens")).join(offsets, order)
    return shift(cut_blocks(placed, carrier, block), carrier, block)
