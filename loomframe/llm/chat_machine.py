"""Chat formatting by a finite-state machine and a declarative template.

The machine says which role may follow which; the template says what stands around a turn, which
strings have a meaning and so must not occur in texts, and which roles are learned. Formatting emits
text segments, each with a loss flag. A control string inside a text is broken up by a backslash
after its first character, and backslashes are doubled, so the text can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START = ""


@dataclass(frozen=True)
class Machine:
    """Which roles may follow a role (``""``: the start), and in which a conversation may end."""

    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant",),
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def allows(self, before: Column, role: Column) -> Column:
        pairs = [f"{a}\n{b}" for a, after in self.follows.items() for b in after]
        return F.concat_ws("\n", F.coalesce(before, F.lit(START)), F.coalesce(role, F.lit("\n"))).isin(pairs)


@dataclass(frozen=True)
class Template:
    """Strings around a turn, further strings with a meaning, and the roles under the loss mask."""

    start: str = "<|im_start|>"
    role_end: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        for control in self.controls:
            if len(control) < 2 or "\\" in control or any(control.endswith(control[:n]) for n in range(1, len(control))):
                raise ValueError(f"{control!r} can't be told apart from text: too short, with a backslash, or ending as it begins")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.role_end, self.end, *self.reserved)

    def escape(self, text: Column) -> Column:
        text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
        for control in self.controls:
            text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
        return text

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of formatted text."""
        marks = map(re.escape, (self.start, self.role_end, self.end))
        turn = re.compile("{}(.*?){}(.*?){}".format(*marks), re.DOTALL)
        turns, at = [], 0
        for found in turn.finditer(formatted):
            if found.start() != at:
                raise ValueError("text between turns")
            turns.append((self.unescape(found[1]), self.unescape(found[2])))
            at = found.end()
        if at != len(formatted):
            raise ValueError("text after the last turn")
        return turns


def format_turns(
    df: DataFrame, template: Template | None = None, machine: Machine | None = None, key: str = "conv_id",
    turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per turn: the key, ``position`` from 0, ``legal`` (may the role stand here?), ``ends_legally``
    (null but on the last turn), and ``segments``, an array of text and loss flag.

    Turns are ordered by turn number, then role and text, nulls first; turns with equal numbers and
    repeated rows all stay. A null text or role is empty; an empty or unknown role is never legal. Rows
    with a null key are one conversation. Illegal turns are marked, not dropped. Other columns are
    left behind. The machine's state is the role before, so one window pass does; it streams, whatever
    the length of a conversation.
    """
    template, machine = template or Template(), machine or Machine()
    order = Window.partitionBy("__key").orderBy("__turn", "__role", "__text")
    rows = df.select(F.col(key).alias("__key"), F.col(turn).alias("__turn"), F.col(role).alias("__role"), F.col(text).alias("__text"))
    is_learned = F.coalesce(F.col("__role").isin(list(template.learned)), F.lit(False))

    def segment(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    never = F.lit(False)
    head = F.concat(F.lit(template.start), template.escape(F.col("__role")), F.lit(template.role_end))
    return (
        rows.withColumn("position", F.row_number().over(order) - 1)
        .withColumn("__before", F.lag("__role").over(order))
        .withColumn("__last", F.lead(F.lit(True)).over(order).isNull())
        .select(
            F.col("__key").alias(key),
            "position",
            (machine.allows(F.when(F.col("position") > 0, F.coalesce("__before", F.lit("\n"))), F.col("__role"))).alias("legal"),
            F.when(F.col("__last"), F.coalesce(F.col("__role").isin(list(machine.final)), never)).alias("ends_legally"),
            F.array(
                segment(head, never), segment(template.escape(F.col("__text")), is_learned), segment(F.lit(template.end), never)
            ).alias("segments"),
        )
    )


def read_back(formatted: DataFrame, template: Template | None = None, key: str = "conv_id") -> DataFrame:
    """Digests of conversations from their formatted turns: what was said, and what the loss covers.

    One row per key: ``n_turns``, ``turns_sha256`` (role, line end, text, line end of each turn),
    ``loss_chars`` and ``loss_sha256`` (all text under the mask, unescaped), ``formatted_chars``,
    ``legal`` (all turns, and the last one). Turns stream through in order; a task holds one Arrow
    batch, however long a conversation is. An empty table gives an empty table.
    """
    template = template or Template()
    kind = formatted.schema[key].dataType
    schema = T.StructType(
        [T.StructField(key, kind), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
         T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
         T.StructField("formatted_chars", T.LongType()), T.StructField("legal", T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None

        def close():
            of, turns, said, chars, learned, written, legal = current
            return [of, turns, said.hexdigest(), chars, learned.hexdigest(), written, legal]

        for batch in batches:
            ready = []
            for of, legal, ends, segments in zip(*[batch.column(c).to_pylist() for c in ("__key", "legal", "ends_legally", "segments")]):
                if current is None or current[0] != of:
                    if current is not None:
                        ready.append(close())
                    current = [of, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
                text = "".join(s["text"] for s in segments)
                for role, said in template.read(text):
                    current[1] += 1
                    current[2].update(f"{role}\n{said}\n".encode())
                for part in segments:
                    if part["loss"]:
                        learned = template.unescape(part["text"])
                        current[3] += len(learned)
                        current[4].update(learned.encode())
                current[5] += len(text)
                current[6] = current[6] and legal and ends is not False
            if ready:
                yield rows(ready)
        if current is not None:
            yield rows([close()])

    def rows(found: list[list]) -> pa.RecordBatch:
        types = pa.schema([(f.name, _arrow(f.dataType)) for f in schema.fields])
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), types)], schema=types)

    return (
        formatted.select(F.col(key).alias("__key"), "position", "legal", "ends_legally", "segments")
        .repartition("__key").sortWithinPartitions("__key", "position").mapInArrow(run, schema)
    )


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
