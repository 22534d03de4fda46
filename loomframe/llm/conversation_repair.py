"""Cheapest repair of conversations: shortest paths with whole-number weights.

A conversation is a directed acyclic graph: layers of places between rows, in each a node for what
the repaired turns so far end in, and edges for keeping, re-roling or deleting the next row and for
inserting turns. The weight of an edge is one whole number of any size: high digits hold its cost, low
digits its letters, each at the place that it has in the audit text, with zeros behind the last. So
sums are compared by cost first and by the audit's letters next, and the least whole number at each
node settles cost, audit and ties at once.

Two paths to one node have used the same rows, so where they cost the same neither audit begins the
other, and the smaller one stays smaller whatever follows. That lets a conversation be cut: blocks of
rows are solved by themselves for every state before and after them, and runs of blocks are solved in
the same way with blocks as edges, level by level. No task sees more than a block or a run of blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import cut_lineage
from loomframe.operators.ordering import row_index

BLOCK_ROWS = 32
BLOCKS_PER_RUN = 32
#: Characters of roles and texts that order rows of one turn; beyond them a digest does.
TIE_CHARS = 32
BLANKS = "\t\n\x0b\f\r "

#: What repaired turns end in: nothing yet, a system, user or assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Which state a turn of this initial leads to.
FOLLOWS = {
    START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER},
}
FINAL = (START, ASSISTANT)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: Digits of letters, in ASCII order; zero is the padding behind the last.
BITS = 3
_DIGITS, _LETTERS = str.maketrans("DIKR", "1234"), str.maketrans("1234", "DIKR")

#: An edge: the state it leads to, cost, letters as digits, number of letters. A layer: the edges of each state.
Edge = tuple[int, int, int, int]
Layer = dict[int, list[Edge]]


def digits(audit: str) -> int:
    return int(audit.translate(_DIGITS) or "0", 8)


def letters(value: int, count: int) -> str:
    return f"{value:o}".zfill(count).translate(_LETTERS) if count else ""


def edge(to: int, cost: int, audit: str) -> Edge:
    return to, cost, digits(audit), len(audit)


#: Turns put in between two rows. Two of them are of use only where none but a system turn stands before;
#: other pairs could be left out for less.
INSERTS: Layer = {
    START: [edge(START, 0, ""), edge(USER, INSERT, "I"), edge(ASSISTANT, 2 * INSERT, "II")],
    SYSTEM: [edge(SYSTEM, 0, ""), edge(USER, INSERT, "I"), edge(ASSISTANT, 2 * INSERT, "II")],
    USER: [edge(USER, 0, ""), edge(ASSISTANT, INSERT, "I")],
    ASSISTANT: [edge(ASSISTANT, 0, ""), edge(USER, INSERT, "I")],
}


@cache
def row_layer(initial: str, fault: str) -> Layer:
    """What may happen to a row; ``fault`` is blank, duplicate, truncated or empty."""
    layer: Layer = {state: [edge(state, DELETE, "D")] for state in FOLLOWS}
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        for state, after in FOLLOWS.items():
            if initial in after:
                layer[state].append(edge(after[initial], KEEP + more, "K"))
            for role in "ua":
                if role in after:
                    layer[state].append(edge(after[role], REROLE + more, "R"))
    return layer


def shortest(layers: list[Layer], entry: int) -> dict[int, Edge]:
    """The least path from a state through all layers to each state that can be reached."""
    width = sum(max(e[3] for edges in layer.values() for e in edges) for layer in layers)
    high = BITS * width
    best = {entry: (0, 0)}  # weight, letters so far
    for layer in layers:
        found: dict[int, tuple[int, int]] = {}
        for state, (weight, at) in best.items():
            for to, cost, said, count in layer.get(state, ()):
                total = weight + (cost << high) + (said << BITS * (width - at - count))
                if to not in found or total < found[to][0]:
                    found[to] = total, at + count
        best = found
    low = (1 << high) - 1
    return {to: (to, weight >> high, (weight & low) >> BITS * (width - at), at) for to, (weight, at) in best.items()}


def cheapest(paths: Iterable[Edge]) -> Edge:
    """The least of whole paths, compared as numbers of one width."""
    paths = list(paths)
    width = max(p[3] for p in paths)
    return min(paths, key=lambda p: (p[1] << BITS * width) + (p[2] << BITS * (width - p[3])))


def solve(initials: list[str], faults: list[str]) -> tuple[int, str]:
    """Cost and audit of one conversation at a time."""
    layers = [INSERTS]
    for initial, fault in zip(initials, faults):
        layers += [row_layer(initial, fault), INSERTS]
    ends = shortest(layers, START)
    _, cost, said, count = cheapest(ends[s] for s in FINAL if s in ends)
    return cost, letters(said, count)


def replay(audit: str) -> Iterator[tuple[int, int, str | None]]:
    """Of each repaired turn: position, row it comes from (-1: none), and its new role (None: as it was).

    The last repaired turn is an assistant's and roles take turns before it, so places from the end tell them.
    """
    left = len(audit) - audit.count("D")
    row, position = -1, 0
    for letter in audit:
        row += letter != "I"
        if letter != "D":
            role = None if letter == "K" else "assistant" if left % 2 else "user"
            yield position, row if letter != "I" else -1, role
            position, left = position + 1, left - 1


_PATH = "array<struct<entry int, exit int, cost long, audit string>>"
_BLOCK = f"__conv string, block long, first string, last string, blank long, duplicate long, truncated long, illegal long, paths {_PATH}"
_LEGAL = ("su", "ua", "au")


def _paths(layers: list[Layer], first: bool) -> list[dict]:
    """All least paths through the layers; only the start leads into a conversation's first block."""
    return [
        {"entry": entry, "exit": to, "cost": cost, "audit": letters(said, count)}
        for entry in ([START] if first else FOLLOWS) for to, cost, said, count in shortest(layers, entry).values()
    ]


def _solve_block(key: str, block: int, rows: list[dict]) -> dict:
    layers = [INSERTS] if block == 0 else []  # what is put in between blocks belongs to the earlier one
    for row in rows:
        layers += [row_layer(row["initial"], row["fault"]), INSERTS]
    initials = [row["initial"] for row in rows]
    faults = [row["fault"] for row in rows]
    return {
        "__conv": key, "block": block, "first": initials[0], "last": initials[-1],
        **{name: faults.count(name) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])), "paths": _paths(layers, block == 0),
    }


def _solve_run(key: str, block: int, parts: list[dict]) -> dict:
    if len(parts) == 1:
        return {"__conv": key, **parts[0], "block": block}
    layers = []
    for part in parts:
        layer: Layer = {}
        for path in part["paths"]:
            layer.setdefault(path["entry"], []).append(edge(path["exit"], path["cost"], path["audit"]))
        layers.append(layer)
    return {
        "__conv": key, "block": block, "first": parts[0]["first"], "last": parts[-1]["last"],
        **{name: sum(p[name] for p in parts) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(p["illegal"] for p in parts) + sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(parts, parts[1:])),
        "paths": _paths(layers, block == 0),
    }


def _solved(grouped: DataFrame, solve_one) -> DataFrame:
    """One block per row of ``__conv, block, parts``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    empty = grouped.sparkSession.createDataFrame([], _BLOCK).schema
    kind = to_arrow_schema(empty)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                rows = batch.slice(low, 1000).to_pylist()
                yield pa.RecordBatch.from_pylist([solve_one(r["__conv"], r["block"], r["parts"]) for r in rows], schema=kind)

    return grouped.mapInArrow(run, empty)


def _key(column: str) -> Column:
    """A text for each value of a key, null included."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def ordered_rows(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with their position in their conversation and their fault: ``__conv, turn, role, text, pos, initial, fault``.

    Rows go by turn, nulls first, then by the first characters of role and text and a digest of both.
    """
    given = df.select(
        _key(key).alias("__conv"), F.col(turn).cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))],
    )
    said = F.sha2(F.concat(F.col("role"), F.lit("\0"), F.char_length("role").cast("string"), F.lit("\0"), F.col("text")).cast("binary"), 256)
    given = given.withColumns({
        "__role": F.substring("role", 1, TIE_CHARS), "__text": F.substring("text", 1, TIE_CHARS), "said": said,
    })
    placed = row_index(given, ["turn", "__role", "__text", "said"], "pos", ["__conv"])
    placed = cut_lineage(placed.drop("__role", "__text"))
    first = placed.groupBy("__conv", "said").agg(F.min("pos").alias("pos")).select("__conv", "pos", F.lit(True).alias("first"))
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    initial = F.substring("role", 1, 1)
    return placed.join(first, ["__conv", "pos"], "left").select(
        "__conv", "pos", "turn", "role", "text",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("?").alias("initial"),
        F.when(end == "", "blank").when(F.col("first").isNull(), "duplicate").when(~end.isin(".", "!", "?"), "truncated").otherwise("").alias("fault"),
    )


def audits(rows: DataFrame) -> DataFrame:
    """Counts, cost and audit of each conversation of :func:`ordered_rows`."""

    def div(name: str, by: int) -> Column:
        return F.call_function("div", F.col(name), F.lit(by).cast("long"))

    grouped = rows.groupBy("__conv", div("pos", BLOCK_ROWS).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "initial", "fault"))).alias("parts")
    )
    blocks = cut_lineage(_solved(grouped, _solve_block))
    while (blocks.agg(F.max("block")).first()[0] or 0) > 0:
        part = F.struct(*[c for c in blocks.columns if c != "__conv"])
        runs = blocks.groupBy("__conv", div("block", BLOCKS_PER_RUN).alias("run")).agg(F.sort_array(F.collect_list(part)).alias("parts"))
        blocks = cut_lineage(_solved(runs.withColumnRenamed("run", "block"), _solve_run))

    @F.udf("struct<cost long, audit string>")
    def best(paths):
        _, cost, said, count = cheapest(edge(p["exit"], p["cost"], p["audit"]) for p in paths if p["exit"] in FINAL)
        return cost, letters(said, count)

    chosen = blocks.withColumn("best", best("paths"))
    return chosen.select("__conv", "blank", "duplicate", "truncated", "illegal", "best.cost", "best.audit")


def repaired_turns(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The turns that :func:`audits` leaves: ``__conv, position, role, text``; those put in have an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["__conv", "position", "pos", "new_role"]
        for batch in batches:
            keys, places = [], []
            for key, audit in zip(batch.column("__conv").to_pylist(), batch.column("audit").to_pylist()):
                for place in replay(audit):
                    keys.append(key)
                    places.append(place)
                    if len(keys) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (keys, *zip(*places))][:3] + [pa.array([p[2] for p in places], pa.string())], names)
                        keys, places = [], []
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (keys, *zip(*places))][:3] + [pa.array([p[2] for p in places], pa.string())], names)

    kept = audited.select("__conv", "audit").mapInArrow(run, "__conv string, position long, pos long, new_role string")
    return kept.join(rows.select("__conv", "pos", "role", "text"), ["__conv", "pos"], "left").select(
        "__conv", "position", F.coalesce("new_role", "role").alias("role"),
        F.when(F.col("pos") < 0, "").otherwise(F.col("text")).alias("text"),
    )


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of the ``role:text`` lines of each conversation. Turns stream through in order; a digest is one stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for of, role, text in zip(*[batch.column(c) for c in ("__conv", "role", "text")]):
                line = f"{role.as_py()}:{text.as_py()}".encode()
                if of.as_py() == key:
                    digest.update(b"\n" + line)
                else:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = of.as_py(), hashlib.sha256(line)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["__conv", "repaired_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["__conv", "repaired_sha256"])

    return turns.repartition("__conv").sortWithinPartitions("__conv", "position").select("__conv", "role", "text").mapInArrow(
        run, "__conv string, repaired_sha256 string"
    )


def repair(
    df: DataFrame, keys: DataFrame | None = None, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: the key, ``gaps``, counts of ``blank, duplicate, truncated, illegal``, ``cost``, ``audit``
    and ``repaired_sha256``, as the ``op11`` contract has them.

    ``keys`` may name conversations of which ``df`` holds no row: they have zeros, an empty audit and the
    digest of nothing. A null role or text is one space, so a row with a null text is blank; rows with a
    null key are one conversation; null turns come first; repeated rows are duplicates. Rows of equal
    turn go by role and text. A turn with an empty role stands nowhere as it is. Other columns are left behind, and an empty table without ``keys`` gives
    an empty table.
    """
    rows = cut_lineage(ordered_rows(df, key, turn, role, text))
    audited = cut_lineage(audits(rows))
    turns = rows.select("__conv", "turn").distinct().groupBy("__conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    said = digests(repaired_turns(rows, audited))
    names = (df if keys is None else keys).select(F.col(key), _key(key).alias("__conv")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (
        names.join(turns, "__conv", "left").join(audited, "__conv", "left").join(said, "__conv", "left")
        .select(
            key, *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        )
    )


def damage(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults dealt by a checksum of key and turn: one row in twenty each is dropped, emptied, cut at its sentence ends,
    repeated, or given to the user. Nulls count as one space."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (key, turn, role, text)}
    kind = F.pmod(F.crc32(F.concat_ws(":", spaced[key], spaced[turn]).cast("binary")), F.lit(20))
    said = F.when(kind == 1, "").when(kind == 2, F.translate(spaced[text], ".!?", "")).otherwise(spaced[text])
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.where(kind != 0).select(
        key, turn, F.when(kind == 4, "user").otherwise(spaced[role]).alias(role), said.alias(text), F.explode(copies).alias("__copy")
    ).drop("__copy")
