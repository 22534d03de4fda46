import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from loomframe.llm import ball_tree as bt

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k):
    counts = [(key, Counter(TERM.findall((text or "").translate(LOWER)))) for key, text in docs]
    n = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        scores = []
        for key, c in counts:
            size = sum(c.values())
            m = 10 + 90 * size * n // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(TERM.findall((text or "").translate(LOWER))) if t in c
            )
            if score > 0:
                scores.append((-score, key is None, key))
        found += [(item, rank, key, -score) for rank, (score, _, key) in enumerate(sorted(scores, key=lambda s: s[:2] + (s[2] or 0,))[:k], 1)]
    return sorted(found, key=lambda r: (r[0] is None, r[0] or 0, *r[1:2]))


def corpus(seed, size):
    pick = random.Random(seed)
    words = [f"{c}{i}" for c in "aBé" for i in range(40)]
    rows = []
    for key in range(size):
        if rows and pick.random() < 0.3:
            rows.append((key, pick.choice(rows)[1]))  # copies, so that scores tie
        else:
            part = pick.sample(words, 12)
            rows.append((key, pick.choice([" ", ", ", "_", "\n"]).join(pick.choice(part) for _ in range(pick.choice([0, 1, 3, 20, 60])))))
    pick.shuffle(rows)
    return rows


def table(spark, rows, name="doc_id"):
    return spark.createDataFrame(rows, f"{name} long, text string")


@pytest.mark.parametrize("tree_rows, leaf", [(16_384, 64), (37, 4)])
def test_against_brute_force(spark, monkeypatch, tree_rows, leaf):
    monkeypatch.setattr(bt, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(bt, "LEAF_ROWS", leaf)
    docs, items = corpus(1, 300), [(i, t) for i, (_, t) in enumerate(corpus(2, 30))]
    got = bt.search(table(spark, docs).repartition(3), table(spark, items, "item_id"), k=7).collect()
    assert sorted(map(tuple, got)) == brute(docs, items, 7)


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(bt, "ITEMS_PER_PASS", 2)
    long = " ".join(f"w{i}" for i in range(60_000)) + "x" * 3_000_000 + " Once"
    docs = [(4, None), (3, ""), (2, "..."), (9, "once once"), (9, "once once"), (None, "once once"), (1, "ÉTÉ once"), (8, long), (-5, "once once")]
    items = [(1, "Once"), (2, None), (3, "nothing"), (1, "Été"), (None, "once ONCE"), (7, "été ÉTÉ")]
    got = sorted(map(tuple, bt.search(table(spark, docs), table(spark, items, "item_id"), k=4).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))
    want = sorted(brute(docs, items, 4), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))
    assert got == want
    assert [r[2] for r in got if r[0] is None] == [-5, 9, 9, None]


def test_empty_tables_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id long, text string, rank string, score int")
    items = spark.createDataFrame([(1, "a c", "y")], "item_id int, text string, doc_id string")
    assert [r[:3] for r in bt.search(docs, items).collect()] == [(1, 1, 1)]
    assert bt.search(docs, items.limit(0)).collect() == []
    assert bt.search(docs.limit(0), items).collect() == []


def test_terms_in_parts(monkeypatch):
    text = "Ab, é_C9 " * 50
    monkeypatch.setattr(bt, "PART_BYTES", 7)
    assert [t.decode() for part in bt.terms(text.encode()) for t in part] == TERM.findall(text.translate(LOWER))


def test_bounds_hold_and_prune():
    pick = np.random.default_rng(3)
    groups = pick.integers(0, 6, 400)
    rows = [np.unique(g * 50 + pick.integers(0, 50, 15)) for g in groups]
    sizes, columns = np.array([len(r) for r in rows]), np.concatenate(rows)
    values = pick.integers(1, 10**6, len(columns))
    tree = bt.BallTree(list(range(400)), sizes, columns, values, 300)
    dense = np.zeros((400, 300), np.int64)
    dense[np.repeat(np.arange(400), sizes), columns] = values
    scored = 0
    for group in range(6):
        query = bt.Query(np.arange(group * 50, group * 50 + 9), pick.integers(0, 9000, 9))
        exact = dense[:, query.terms] @ query.weights
        for (low, high), bound in zip(tree.spans, tree.bounds(query)):
            assert exact[tree.order[low:high]].max() <= bound
        best = bt.Best(5)
        scored += tree.search(query, best)
        assert sorted((s, k) for s, _, k in best.kept) == sorted((int(exact[i]), i) for i in np.lexsort((np.arange(400), -exact))[:5])
    assert scored < 6 * 400 / 2
