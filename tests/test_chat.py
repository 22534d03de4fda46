import random

import pytest
from pyspark.sql import functions as F

from loomframe.operators import bpe, chat
from loomframe.operators.tokens import BYTES, ArrayCarrier
from tests import models

TURNS = "conv long, turn long, role string, text string"


def chats(seed, n=25):
    rng = random.Random(seed)
    out = {}
    for conv in range(n):
        length = 60 if conv == 0 else rng.randint(1, 5)
        out[conv] = [
            (rng.choice(["prompter", "assistant", "system"]), "".join(rng.choice("ab é\n") for _ in range(rng.randint(0, 25))))
            for _ in range(length)
        ]
    return out


def rows_of(convs):
    return [(c, i * 2, role, text) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]


@pytest.mark.parametrize("block", [4, 33, 200])
def test_examples_equal_the_sequential_model(spark, ranges, block):
    convs = chats(3)
    df = spark.createDataFrame(rows_of(convs), TURNS).repartition(3)
    got = chat.sft_examples(df, BYTES, block, "conv", "turn").collect()
    assert {r.conv: (r.input_ids, r.labels) for r in got} == {c: models.example(t, block) for c, t in convs.items()}


def test_other_roles_can_be_context(spark):
    df = spark.createDataFrame([(1, 0, "system", "be kind"), (1, 1, "assistant", "ok")], TURNS)
    every = chat.sft_examples(df, BYTES, 64, "conv", "turn").first()
    some = chat.sft_examples(df, BYTES, 64, "conv", "turn", others=("assistant",)).first()
    assert every.input_ids == some.input_ids
    assert sum(v != -1 for v in every.labels) > sum(v != -1 for v in some.labels) == len("ok\n<|endofturn|>")


def test_piecewise_encoding_of_segments(spark):
    vocabulary = bpe.Vocabulary.from_merges([b"\n\n", b"ab"])
    turns = spark.createDataFrame([(1, 0, "assistant", "\nab")], TURNS)
    segments = turns.select("conv", "turn", F.posexplode(chat.segments(F.col("role"), F.col("text"))).alias("seg", "s"))
    flat = segments.select("conv", F.concat_ws("-", "conv", "turn", "seg").alias("id"), "seg", F.col("s.text").alias("text"), F.col("s.mask").alias("mask"))
    encoded = flat.join(bpe.encode(flat, "id", "text", vocabulary), "id")
    body = F.slice("tokens", 1, F.size("tokens") - 1)
    ready = encoded.select("conv", "seg", body.alias("tokens"), F.when(F.col("mask") == 0, F.size(body)).otherwise(0).cast("long").alias("masked"))
    got = chat.examples_from_tokens(ready, ArrayCarrier(vocabulary.end), 40, "conv", "seg").first()
    # the line break before the text and the one that opens it stay two tokens
    ids = [*b"<|assistant|>", 10, 10, vocabulary.ranks[b"ab"], 10, *b"<|endofturn|>"]
    assert got.input_ids == (ids + [vocabulary.end] * 40)[:40]
    assert [v for v in got.labels if v != -1] == ids[14:]


def test_instruction_turns(spark):
    pairs = [
        (1, "do", "", "done"), (2, "do", None, "done"), (3, "do", " \n", "done"), (4, "do", " it ", "done"), (5, "do", "x", " 　"),
    ]
    df = spark.createDataFrame(pairs, "id long, instruction string, input string, output string")
    got = chat.instruction_turns(df, "id").orderBy("id", "pos").collect()
    asked = {r.id: r.text for r in got if r.pos == 0}
    assert asked == {1: "do", 2: "do", 3: "do", 4: "do\n\nInput:  it "}
    assert {(r.role, r.text) for r in got if r.pos == 1} == {("assistant", "done")}


def test_rendered_turns(spark):
    df = spark.createDataFrame([(1, 0, "prompter", "hi"), (1, 1, "assistant", "yo")], TURNS)
    got = [r.s for r in df.select(chat.rendered(F.col("role"), F.col("text")).alias("s")).collect()]
    assert got == ["<|user|>\nhi\n", "<|assistant|>\nyo\n<|endofturn|>"]


@pytest.mark.parametrize("budget", [5, 40, 10_000])
def test_context_is_the_tail_of_the_chat(spark, ranges, budget):
    convs = {c: [(r if r != "system" else "assistant", t) for r, t in turns] for c, turns in chats(8).items()}
    df = spark.createDataFrame(rows_of(convs), TURNS).repartition(3)
    got = {(r.conv, r.turn): r.context for r in chat.chat_context(df, BYTES, budget, "conv", "turn").collect()}
    want = {}
    for conv, turns in convs.items():
        seen = []
        for i, (role, text) in enumerate(turns):
            said = f"<|user|>\n{text}\n<|assistant|>\n" if role == "prompter" else f"{text}\n<|endofturn|>"
            seen += [*said.encode()]
            if role == "prompter":
                want[conv, i * 2] = seen[-budget:]
    assert got == want


def test_commands_and_sessions(spark, ranges):
    lines = ["hello", "/temp\u00a0 0.9\t", "a", "/reset", " ", "/topk 40", "/TOPK x", "/what", "/quit", "b"]
    df = spark.createDataFrame(list(enumerate(lines)), "ord long, line string")
    parsed = df.select("ord", "line", *[c.alias(n) for n, c in chat.chat_commands(F.col("line")).items()])
    rows = {r.line: r for r in parsed.collect()}
    assert [line for line in lines if rows[line].says] == ["hello", "a", "b"]
    assert rows["/temp\u00a0 0.9\t"].temperature == 0.9 and rows["/topk 40"].top_k == 40 and rows["/TOPK x"].top_k is None
    assert rows["/quit"].leaves and rows["/reset"].reset and not rows["/what"].says
    settings = {"temperature": F.col("temperature"), "top_k": F.col("top_k")}
    got = chat.reset_sessions(parsed.withColumn("chat", F.lit("c")), ["chat"], ["ord"], F.col("reset"), settings).orderBy("ord").collect()
    assert [r.session_id for r in got] == [0, 0, 0, 1, 1, 1, 1, 1, 1, 1]
    assert [r.temperature for r in got] == [None] + [0.9] * 9
    assert got[-1].top_k == 40


def test_roles(spark):
    df = spark.createDataFrame([("user",), ("assistant",), ("odd",)], "role string")
    got = chat.map_roles(df, {"user": "prompter"}).select("role", chat.is_trained(F.col("role")).alias("m")).collect()
    assert [(r.role, r.m) for r in got] == [("prompter", 0), ("assistant", 1), ("odd", 1)]


def test_context_keeps_turns_without_text(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "prompter", None), (1, 2, "assistant", None), (1, 3, "prompter", "q")]
    got = chat.chat_context(spark.createDataFrame(rows, "c long, t long, role string, text string"), BYTES, 1000, "c", "t").orderBy("t").collect()
    first = "s\n<|endofturn|><|user|>\n\n<|assistant|>\n"
    assert [bytes(r.context).decode() for r in got] == [first, first + "\n<|endofturn|><|user|>\nq\n<|assistant|>\n"]
