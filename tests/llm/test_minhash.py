import random

import numpy as np
import pytest

from loomframe.llm import minhash as mh
from loomframe.llm.components import components


def sets_of(text, shingle):
    w = (text or "").encode().lower().split()
    if len(w) < shingle:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)}


def brute(rows, shingle, percent):
    sets = {k: sets_of(t, shingle) for k, t in rows}
    up = {k: k for k in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return sorted((k, len(sets[k]), find(k), find(k) == k) for k in keys)


def corpus(seed, size=120):
    pick = random.Random(seed)
    rows, words = [], [f"w{i}" for i in range(300)]
    for k in range(size):
        if rows and pick.random() < 0.7:
            w = (pick.choice(rows)[1] or "").split()
            for _ in range(pick.randint(0, 4)):
                if w:
                    w[pick.randrange(len(w))] = pick.choice(words)
        else:
            w = [pick.choice(words) for _ in range(pick.choice([0, 1, 2, 3, 10, 40, 80]))]
        rows.append((k, pick.choice([" ".join, "\n ".join])(x.upper() if pick.random() < 0.1 else x for x in w)))
    return rows


@pytest.mark.parametrize("tile", [1_000_000, 300])
@pytest.mark.parametrize("shingle, percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, monkeypatch, tile, shingle, percent):
    monkeypatch.setattr(mh, "TILE", tile)
    rows = corpus(shingle)
    got = mh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shingle=shingle, percent=percent)
    assert sorted(map(tuple, got.collect())) == brute(rows, shingle, percent)


def test_edge_cases(spark):
    long = " ".join(f"x{i}" for i in range(20_000))
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n", "c"), (4, "One", "d"), (5, "one", "e"), (6, long, "f"), (7, long + " more", "g"), (None, "one", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string")
    got = {r["doc_id"]: (r["n_shingles"], r["component"], r["kept"]) for r in mh.near_duplicates(df, shingle=3, percent=85).collect()}
    assert got == {
        1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (1, 4, True), 5: (1, 4, False), 6: (19_998, 6, True), 7: (19_999, 6, False),
        None: (1, None, True),
    }
    assert mh.near_duplicates(df.limit(0)).collect() == []


def test_repeated_rows(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (3, "a b c d")]
    got = mh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85)
    assert sorted(map(tuple, got.collect())) == [(3, 2, 3, True), (5, 2, 3, False)]


def plain_super_minhash(items, size):
    """One item and one rank at a time."""
    h = np.full(size, np.inf)
    for x in items:
        p = list(range(size))
        for rank in range(size):
            bits = int(mh._mixed(np.array([x], np.uint64), rank)[0])
            value = (bits >> 32) / 2.0**32 + rank
            k = rank + (((bits & 0xFFFFFFFF) * (size - rank)) >> 32)
            p[rank], p[k] = p[k], p[rank]
            h[p[rank]] = min(h[p[rank]], value)
    return h


def test_signature_is_super_minhash():
    rng = np.random.default_rng(1)
    sizes = [1, 2, 7, 40, 300]
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in sizes]
    got = mh.super_minhash(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets), 16)
    for row, items in zip(got, sets):
        assert np.array_equal(row, plain_super_minhash(items, 16))


def test_estimate_is_close():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        a = rng.integers(0, 2**63, 200).astype(np.uint64)
        b = np.concatenate([a[:150], rng.integers(0, 2**63, 50).astype(np.uint64)])
        s = mh.super_minhash(np.concatenate([a, b]), np.repeat([0, 1], 200), 2, 64)
        errors.append((s[0] == s[1]).mean() - 150 / 250)
    assert abs(np.mean(errors)) < 0.03


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 400)] + [(1000, k) for k in range(1001, 1300)] + [(7, 7), (None, 3), (2000, 1999), (1999, 2000)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    want = {i: 0 for i in range(401)} | {i: 1000 for i in range(1000, 1300)} | {1999: 1999, 2000: 1999}
    assert got == want
