import hashlib
import random

import pytest

from loomframe.llm import chat_machine as cm

SCHEMA = "conv_id long, turn long, role string, text string"
FOLLOWS = {"": {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user", "tool"}, "tool": {"assistant"}}


def brute(rows):
    talks = {}
    for row in rows:
        talks.setdefault(row[0], []).append(row)
    low = lambda v: (v is not None, v)
    out = {}
    for key, turns in talks.items():
        turns.sort(key=lambda r: (low(r[1]), low(r[2]), low(r[3])))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        learned = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        state, legal = "", True
        for r in turns:
            legal &= (r[2] or "?") in FOLLOWS.get(state, ())
            state = r[2] or "?"
        legal &= state == "assistant"
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[key] = (len(turns), digest(said), len(learned), digest(learned), legal)
    return out


def run(spark, rows, template=None):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = cm.read_back(cm.format_turns(df, template), template).collect()
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["legal"]) for r in got}


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    pick = random.Random(seed)
    parts = [*cm.Template().controls, "\\", "\\\\", "<", "|", "[", "é", "\U0001f600", "\n", " ", "text", "<\\s>", "<|im_", "end|>"]
    rows = []
    for key in range(60):
        roles = ["system"] * pick.randint(0, 1) + ["user", "assistant"] * pick.randint(1, 4)
        if pick.random() < 0.3:
            pick.shuffle(roles)
        rows += [(key, i, r, "".join(pick.choices(parts, k=pick.randint(0, 12)))) for i, r in enumerate(roles)]
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "long " * 100_000), (2, 0, None, "no role"), (3, 0, "odd <s> role\n", "x"),
            (4, 1, "assistant", "tie b"), (4, 1, "assistant", "tie a"), (4, 0, "user", "q"), (None, None, "user", "a"), (None, None, "user", "a"),
            (5, 0, "tool", ""), (6, 0, "assistant", "first"), (7, 0, "user", "ends here")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == {}


def test_no_control_string_survives_in_a_text(spark):
    template = cm.Template()
    text = "".join(template.controls) + "<<s>s>" + "\\<s>" + "<|im_<|im_end|>end|>"
    df = spark.createDataFrame([(1, 0, "assistant", text)], SCHEMA)
    body = cm.format_turns(df).first()["segments"][1]
    assert body["loss"] and not [c for c in template.controls if c in body["text"]]
    assert template.unescape(body["text"]) == text


def test_segments_and_flags(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "user", "again"), (1, 2, "assistant", "yes")]
    df = spark.createDataFrame([(*r, "own") for r in rows], SCHEMA + ", segments string")
    got = cm.format_turns(df).orderBy("position").collect()
    assert [r["legal"] for r in got] == [True, False, True] and [r["ends_legally"] for r in got] == [None, None, True]
    assert [[tuple(s) for s in r["segments"]] for r in got][2] == [("<|im_start|>assistant<|im_sep|>", False), ("yes", True), ("<|im_end|>", False)]


def test_other_template_and_machine(spark):
    template = cm.Template(start="[[T]", role_end="[:]", end="[/T]", reserved=(), learned=("bot", "user"))
    rows = [(1, 0, "user", "[/T] [[T] x"), (1, 1, "bot", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    machine = cm.Machine({"": ("user",), "user": ("bot",)}, ("bot",))
    got = cm.read_back(cm.format_turns(df, template, machine), template).first()
    assert got["legal"] and got["loss_chars"] == len("[/T] [[T] xy")
    with pytest.raises(ValueError):
        cm.Template(start="aba")


def test_text_that_was_not_formatted_is_refused():
    with pytest.raises(ValueError):
        cm.Template().read("plain")
