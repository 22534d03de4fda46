"""Chat template, loss mask, supervised examples and rolling chat context."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.functions.text import SPACE_CLASS, is_blank, strip
from loomframe.operators.ordering import Running, running
from loomframe.operators.packing import spans, whole
from loomframe.operators.tokens import Carrier
from loomframe.session import cut_lineage

# Role name and turn markers the data format prescribes. The markers are ordinary text.
PROMPTER = "prompter"
USER_MARK = "<|user|>"
ASSISTANT_MARK = "<|assistant|>"
END_MARK = "<|endofturn|>"
IGNORED = -1


def map_roles(turns: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename roles, e.g. ``{"user": "prompter"}``; others stay."""
    role = F.col("role")
    for theirs, ours in names.items():
        role = F.when(F.col("role") == theirs, ours).otherwise(role)
    return turns.withColumn("role", role)


def is_trained(role: Column, others: tuple[str, ...] | None = None) -> Column:
    """1 where the turn counts towards the loss.

    Every role but the prompter is trained on; ``others`` narrows that to the roles it lists.
    """
    trained = role != PROMPTER if others is None else role.isin(*others)
    return F.when(F.coalesce(trained, F.lit(True)), 1).otherwise(0)


def instruction_turns(pairs: DataFrame, key: str) -> DataFrame:
    """Instruction, optional input and output to two turns: ``key, pos, role, text``."""
    prompt = F.when(is_blank(F.col("input")), F.col("instruction")).otherwise(
        F.concat(F.col("instruction"), F.lit("\n\nInput: "), F.col("input"))
    )
    turns = F.array(
        F.struct(F.lit(PROMPTER).alias("role"), prompt.alias("text")),
        F.struct(F.lit("assistant").alias("role"), F.col("output").alias("text")),
    )
    return (
        pairs.where(~is_blank(F.col("output")))
        .select(key, F.posexplode(turns).alias("pos", "turn"))
        .select(key, F.col("pos").cast("long").alias("pos"), "turn.role", "turn.text")
    )


def segments(role: Column, text: Column) -> Column:
    """A turn as an array of ``(text, mask)``; each segment is encoded on its own."""

    def segment(part: Column | str, mask: int) -> Column:
        return F.struct((F.lit(part) if isinstance(part, str) else part).alias("text"), F.lit(mask).alias("mask"))

    asked = F.array(segment(USER_MARK, 0), segment(F.concat(F.lit("\n"), text, F.lit("\n")), 0))
    answered = F.array(
        segment(ASSISTANT_MARK, 0), segment("\n", 0), segment(text, 1), segment("\n", 1), segment(END_MARK, 1)
    )
    return F.when(role == PROMPTER, asked).otherwise(answered)


def rendered(role: Column, text: Column) -> Column:
    """A turn as one string."""
    return F.array_join(F.transform(segments(role, text), lambda s: s["text"]), "")


def _with_tokens(turns: DataFrame, carrier: Carrier, key: str, order: str, others: tuple[str, ...] | None) -> DataFrame:
    """``key, order, tokens, masked``: tokens of each turn, and how many of them at its front carry no loss.

    Markers are literals and a turn's own segment is encoded once, whatever its role.
    """
    text, asks = F.coalesce("text", F.lit("")), F.col("role") == PROMPTER
    own = F.when(asks, F.concat(F.lit("\n"), text, F.lit("\n"))).otherwise(text)
    said = turns.select(key, order, "role", carrier.from_text(own).alias("own"))
    user, assistant, line, end = [carrier.from_literal(t) for t in (USER_MARK, ASSISTANT_MARK, "\n", END_MARK)]
    tokens = F.when(asks, carrier.concat(user, F.col("own"))).otherwise(carrier.concat(assistant, line, F.col("own"), line, end))
    whole_turn = asks | (is_trained(F.col("role"), others) == 0)
    lead = carrier.count(carrier.concat(assistant, line))
    return said.select(key, order, whole_turn.alias("whole_turn"), tokens.alias("tokens")).select(
        key, order, "tokens", F.when(F.col("whole_turn"), carrier.count(F.col("tokens"))).otherwise(lead).alias("masked")
    )


def _cut_to_block(turns: DataFrame, carrier: Carrier, block: int, key: str, order: str,
                  rows: int | None) -> DataFrame:
    """The first ``block + 1`` tokens of each conversation, turn by turn.

    Positions come from running lengths, so turns beyond the block are dropped before anything is
    collected and a conversation of any length contributes at most ``block + 1`` tokens.
    """
    total = block + 1
    short = turns.withColumns({"n": carrier.count(F.col("tokens"))}).withColumn(
        "tokens", carrier.cut(F.col("tokens"), F.lit(0), F.least(F.col("n"), F.lit(total)))
    )
    placed = running(short, [order], {"start": Running("sum", F.col("n"), current=False)}, [key], rows)
    room = F.least(F.col("n"), F.lit(total) - F.col("start"))
    return placed.where((F.col("start") < total) & (F.col("n") > 0)).select(
        key,
        "start",
        carrier.cut(F.col("tokens"), F.lit(0), room).alias("tokens"),
        room.cast("int").alias("n"),
        F.least(F.col("masked"), room).cast("int").alias("masked"),
    )


def sft_examples(
    turns: DataFrame, carrier: Carrier, block: int, key: str, order: str,
    others: tuple[str, ...] | None = None, rows: int | None = None,
) -> DataFrame:
    """Turns (``key, order, role, text``) to ``key, input_ids, labels`` of ``block`` tokens each.

    Long conversations lose their end, short ones are padded; labels are -1 wherever there is no loss.
    """
    return examples_from_tokens(_with_tokens(turns, carrier, key, order, others), carrier, block, key, order, rows)


def examples_from_tokens(
    turns: DataFrame, carrier: Carrier, block: int, key: str, order: str, rows: int | None = None
) -> DataFrame:
    """The same from encoded turns: ``tokens``, and ``masked`` leading tokens without loss."""
    kept = _cut_to_block(turns, carrier, block, key, order, rows)
    whole_chat = kept.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("start", "tokens", "n", "masked"))).alias("parts")
    )
    ids = carrier.ids(carrier.join(F.transform("parts", lambda p: p["tokens"])))
    mask = F.flatten(
        F.transform(
            "parts",
            lambda p: F.concat(
                F.array_repeat(F.lit(0), p["masked"]), F.array_repeat(F.lit(1), p["n"] - p["masked"])
            ),
        )
    )
    missing = F.lit(block + 1) - F.size("ids")
    padded = whole_chat.select(key, ids.alias("ids"), mask.alias("mask")).select(
        key,
        F.concat("ids", F.array_repeat(F.lit(carrier.end), missing)).alias("ids"),
        F.concat("mask", F.array_repeat(F.lit(0), missing)).alias("mask"),
    )
    return padded.select(
        key,
        F.slice("ids", 1, block).alias("input_ids"),
        F.zip_with(
            F.slice("ids", 2, block), F.slice("mask", 2, block), lambda t, m: F.when(m == 0, IGNORED).otherwise(t)
        ).alias("labels"),
    )


def chat_context(
    turns: DataFrame, carrier: Carrier, budget: int, key: str, order: str, rows: int | None = None
) -> DataFrame:
    """What the responder sees at each prompter turn: the last ``budget`` tokens of the chat so far.

    The chat's token stream is cut into buckets of ``budget`` tokens; any context lies in two
    neighbouring buckets, so each is put together by equi-joins on the bucket number and no chat
    is ever collected whole.
    """
    text = F.coalesce("text", F.lit(""))
    asked = F.concat(F.lit(USER_MARK + "\n"), text, F.lit("\n" + ASSISTANT_MARK + "\n"))
    answered = F.concat(text, F.lit("\n" + END_MARK))
    is_prompt = F.coalesce(F.col("role") == PROMPTER, F.lit(False))
    said = turns.select(
        key, order, is_prompt.alias("is_prompt"),
        carrier.from_text(F.when(is_prompt, asked).otherwise(answered)).alias("tokens"),
    ).withColumn("n", carrier.count(F.col("tokens")))
    placed = cut_lineage(running(said, [order], {"start": Running("sum", F.col("n"), current=False)}, [key], rows))
    pool = cut_lineage(spans(placed, carrier, budget, 0, "bucket", (key,)).select(key, "bucket", "chunk"))
    ends = placed.where("is_prompt").select(key, order, (F.col("start") + F.col("n")).alias("end"))
    ends = ends.withColumn("bucket", whole(F.col("end") - 1, budget))
    used = F.col("end") - F.col("bucket") * budget  # tokens of the last bucket in view
    last = ends.join(pool, [key, "bucket"]).select(
        key, order, "end", "bucket", carrier.cut(F.col("chunk"), F.lit(0), used).alias("head"), used.alias("used")
    )
    before = pool.select(key, (F.col("bucket") + 1).alias("bucket"), F.col("chunk").alias("previous"))
    joined = last.join(before, [key, "bucket"], "left")
    tail = carrier.cut(F.col("previous"), F.col("used"), F.lit(budget) - F.col("used"))
    context = F.when(F.col("previous").isNull(), F.col("head")).otherwise(carrier.concat(tail, F.col("head")))
    return joined.select(key, order, carrier.ids(context).alias("context"))


def chat_commands(line: Column) -> dict[str, Column]:
    """What a typed chat line does: reset, set temperature, set top-k, or say something."""
    said = strip(line)
    words = F.split(F.lower(said), f"(?U)[{SPACE_CLASS}]+")
    first, second = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    is_command = F.startswith(said, F.lit("/"))
    return {
        "reset": first == "/reset",
        "leaves": first.isin("/quit", "/exit"),
        "temperature": F.when(first == "/temp", second.try_cast("double")),
        "top_k": F.when(first == "/topk", second.try_cast("int")),
        "says": ~is_blank(line) & ~is_command,
    }


def reset_sessions(
    lines: DataFrame, group: list[str], order: list[str], reset: Column, settings: dict[str, Column],
    rows: int | None = None,
) -> DataFrame:
    """Number the stretches between resets and carry the last value of each setting forward."""
    values = {"session_id": Running("sum", F.when(reset, 1).otherwise(0).cast("long"))}
    values |= {name: Running("last", value) for name, value in settings.items()}
    return running(lines, order, values, group, rows)
