import hashlib
import random
import re

import pytest

from loomframe.llm import conversation_repair as cr

LEGAL = re.compile("(s?(ua)+)?")


def faults_of(rows):
    seen, found = set(), []
    for role, text in rows:
        said = text.strip(cr.BLANKS)
        found.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def brute(rows):
    """All edits: cost, audit and repaired turns."""
    faults = faults_of(rows)
    best = []

    def go(i, cost, audit, turns):
        if best and cost > best[0][0]:
            return
        if i == len(rows) and LEGAL.fullmatch("".join(r[:1] or "?" for r, _ in turns)):
            best[:] = min([*best, (cost, audit, turns)], key=lambda b: b[:2]),
        if audit.count("I") < 2:
            for role in ("user", "assistant"):
                go(i, cost + 5, audit + "I", [*turns, (role, "")])
        if i < len(rows):
            go(i + 1, cost + 2, audit + "D", turns)
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                go(i + 1, cost + more, audit + "K", [*turns, rows[i]])
                for role in ("user", "assistant"):
                    go(i + 1, cost + more + 1, audit + "R", [*turns, (role, rows[i][1])])

    go(0, 0, "", [])
    cost, audit, turns = best[0]
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def conversations(seed, count, longest):
    pick = random.Random(seed)
    found = {}
    for key in range(count):
        found[key] = [
            (pick.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), pick.choice(["Yes.", "No", "A b!", " ", "So?", "x\n"]) + pick.choice(["", "", str(i) + "."]))
            for i in range(pick.randint(1, longest))
        ]
    return found


def table(spark, found):
    return spark.createDataFrame([(k, i, r, t) for k, rows in found.items() for i, (r, t) in enumerate(rows)], "conv_id long, turn long, role string, text string")


def expected(rows):
    faults = faults_of(rows)
    initials = [r[:1] or "?" for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return tuple(faults.count(f) for f in ("blank", "duplicate", "truncated")) + (illegal,)


@pytest.mark.parametrize("block, run", [(32, 32), (2, 2)])
def test_against_brute_force(spark, monkeypatch, block, run):
    monkeypatch.setattr(cr, "BLOCK_ROWS", block)
    monkeypatch.setattr(cr, "BLOCKS_PER_RUN", run)
    found = conversations(block, 80, 6)
    got = {r["conv_id"]: r for r in cr.repair(table(spark, found).repartition(4)).collect()}
    assert len(got) == len(found)
    for key, rows in found.items():
        r = got[key]
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == brute(rows), rows
        assert (r["blank"], r["duplicate"], r["truncated"], r["illegal"]) == expected(rows)
        assert r["gaps"] == 0


def test_blocks_give_what_one_pass_gives(spark, monkeypatch):
    found = conversations(9, 2, 400)
    found[7] = [("user", f"Say {i}" + "." * (i % 3 > 0)) if i % 5 else ("assistant", "Same.") for i in range(3000)]
    want = {}
    for key, rows in found.items():
        initials = [r[:1] if r[:1] in ("s", "u", "a") else "?" for r, _ in rows]
        want[key] = cr.solve(initials, faults_of(rows))
    monkeypatch.setattr(cr, "BLOCK_ROWS", 8)
    monkeypatch.setattr(cr, "BLOCKS_PER_RUN", 3)
    got = cr.repair(table(spark, found)).collect()
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in got} == want


def test_weights_order_as_cost_and_letters_do():
    pick = random.Random(1)
    paths = {(pick.randint(0, 3), "".join(pick.choice("DIKR") for _ in range(pick.randint(0, 5)))) for _ in range(200)}
    for _ in range(300):
        some = pick.sample(sorted(paths), 4)
        to, cost, said, count = cr.cheapest(cr.edge(0, *p) for p in some)
        assert (cost, cr.letters(said, count)) == min(some)


def test_edge_cases(spark):
    rows = [
        (1, None, "user", "Null turn."), (1, 5, "assistant", "Five."), (1, 9, "user", None), (None, 1, "user", "Hi."), (None, 2, None, "Ho."),
        (3, None, "tool", "x"), (4, 1, "system", "Only."), (5, 1, "user", "Twice."), (5, 1, "user", "Twice."), (5, 2, "assistant", "Y" * 300_000 + "."),
    ]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, pos int")
    keys = spark.createDataFrame([(k,) for k in (1, None, 3, 4, 5, 6)], "conv_id long")
    got = {r["conv_id"]: r for r in cr.repair(df, keys).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert {k: (r["gaps"], r["cost"], r["audit"], r["blank"], r["duplicate"]) for k, r in got.items()} == {
        1: (3, 2, "KKD", 1, 0), None: (0, 1, "KR", 0, 0), 3: (0, 2, "D", 0, 0), 4: (0, 2, "D", 0, 0), 5: (0, 2, "KDK", 0, 1), 6: (0, 0, "", 0, 0),
    }
    assert got[None]["repaired_sha256"] == sha("user:Hi.\nassistant:Ho.")
    assert got[6]["repaired_sha256"] == got[4]["repaired_sha256"] == sha("")
    assert cr.repair(df.limit(0)).collect() == []
    assert [r["audit"] for r in cr.repair(df.limit(0), keys.limit(1)).collect()] == [""]


def test_damage(spark):
    import zlib

    rows = [(k, t, "assistant" if t % 2 else None, "A. b! c?" if t % 3 else None) for k in range(40) for t in range(4)] + [(None, None, "user", "x.")]
    got = sorted(map(tuple, cr.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=str)
    want = []
    for key, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(key, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(want, key=str)
