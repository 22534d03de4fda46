import random

import pytest

from loomframe.llm import substring_dedup as sd


def brute(rows, window):
    """(key, text) -> kept words per row, by first coordinate of each run."""
    words = [(k, (t or "").encode().split()) for k, t in rows]
    first = {}
    for k, w in words:
        if k is None:
            continue
        for i in range(len(w) - window + 1):
            run = tuple(w[i : i + window])
            first[run] = min(first.get(run, (k, i)), (k, i))
    out = []
    for k, w in words:
        gone = set()
        if k is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i : i + window])] < (k, i):
                    gone.update(range(i, i + window))
        out.append((k, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def run(spark, rows, window=5, anchor=2, parts=4, schema="doc_id long, text string"):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    got = sd.dedup(df, window=window, anchor=anchor)
    return sorted(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    pick = random.Random(seed)
    shared = [[pick.choice("abcdefgh") + str(pick.randint(0, 9)) for _ in range(pick.randint(4, 14))] for _ in range(5)]
    rows = []
    for k in range(60):
        w = []
        for _ in range(pick.randint(0, 5)):
            w += pick.choice(shared) if pick.random() < 0.5 else [pick.choice("ab") for _ in range(pick.randint(1, 9))]
        rows.append((k, pick.choice([" ", "\n", "\t "]).join(w)))
    assert run(spark, rows) == sorted(brute(rows, 5), key=repr)


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "  "), (4, "a b c d e f g"), (None, "a b c d e f g"), (5, "x a b c d e f g"),
            (6, "t t t t t t t t t"), (7, long), (8, long + " end"), (9, "a b c d e")]
    assert run(spark, rows) == sorted(brute(rows, 5), key=repr)


def test_rows_of_one_key_are_one_document(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")]
    assert run(spark, rows) == [(1, 6, 0, "a b c d e f")] * 2 + [(2, 6, 6, "")]


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a b c d e f", "x", 7, 1), (2, "a b c d e f", "y", 8, 2)], "doc_id long, text string, spans string, n_words int, key int")
    got = sd.dedup(df, window=5, anchor=2).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["key"], r["n_removed"], r["kept_text"]) for r in got] == [(1, 1, 0, "a b c d e f"), (2, 2, 6, "")]
    assert got[1]["spans"][0].asDict() == {"start": 0, "words": 6, "source": 1, "source_start": 0}


def test_copies_and_spans(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(k, f"start{k} {passage} end{k}") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = sd.dedup(df).collect()
    assert all(r["n_removed"] == (60 if r["doc_id"] else 0) for r in got)
    assert all(len(r["spans"]) == 1 and r["spans"][0]["words"] == 60 for r in got if r["doc_id"])
