import hashlib
import random

import numpy as np
import pytest

from loomframe.llm import winnowing as wn


def plain(text, k, w):
    """One window at a time."""
    if not text:
        return []
    k = min(k, len(text))
    hashes = [int(wn._mixed(wn.run_hashes(np.array([ord(c) + 1 for c in text[i : i + k]], np.uint64), k, wn.BASE)[:1])[0]) for i in range(len(text) - k + 1)]
    w = min(w, len(hashes))
    kept = set()
    for i in range(len(hashes) - w + 1):
        least = min(hashes[i : i + w])
        kept.add(max(j for j in range(i, i + w) if hashes[j] == least))
    return [(j, hashes[j]) for j in sorted(kept)]


def text_of(pick, size):
    return "".join(pick.choice("ab é\n") for _ in range(size))


@pytest.mark.parametrize("part", [1 << 18, 9])
@pytest.mark.parametrize("k, w", [(3, 4), (12, 20), (1, 1)])
def test_winnow(monkeypatch, part, k, w):
    monkeypatch.setattr(wn, "PART_CHARS", part)
    pick = random.Random(k)
    for size in [0, 1, 2, 5, 11, 12, 30, 31, 32, 33, 90]:
        text = text_of(pick, size)
        places, hashes = wn.winnow(text, k, w)
        assert list(zip(places.tolist(), hashes.tolist())) == plain(text, k, w)
    assert plain("a" * 60, k, w) == list(zip(*(x.tolist() for x in wn.winnow("a" * 60, k, w))))  # equal hashes: the rightmost


def test_guarantee():
    pick = random.Random(5)
    common = "".join(pick.choice("abcdefgh") for _ in range(wn.K + wn.W - 1))
    for _ in range(20):
        one, two = ("".join(pick.choice("ijklmnop") for _ in range(pick.randint(0, 50))) for _ in range(2))
        a, b = wn.winnow(one + common + two), wn.winnow(two + common)
        shared = np.intersect1d(a[1], b[1])
        assert len(shared)
        at = {h: p for p, h in zip(*a)}
        there = {h: p for p, h in zip(*b)}
        assert any(at[h] - len(one) == there[h] - len(two) for h in shared)


def brute(rows):
    rows = [(k, t or "") for k, t in rows]
    found = []
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        sets = [{h for _, h in plain(t, wn.K, wn.W)} for t in (text, edited, after)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        found.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), *near))
    return found


@pytest.mark.parametrize("size", [1 << 20, 300])
def test_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(wn, "RANGE_BYTES", size)
    pick = random.Random(2)
    rows = [(k * 3, text_of(pick, pick.choice([0, 1, 3, 40, 150]))) for k in range(60)] + [(1000, None), (1001, "same " * 30), (1002, "same " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in wn.against_next(df).collect()}
    assert [tuple(got[k][c] for c in ("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")) for k, _ in rows] == brute(rows)
    assert got[1001]["fingerprint"] == got[1002]["fingerprint"] and got[1001]["near_next"] == 1.0
    for key, text in rows:
        places, hashes = wn.winnow(text or "")
        assert got[key]["fingerprint"] == wn.spelled(places, hashes)


def test_edge_cases(spark):
    long = "x y" * 400_000
    rows = [(None, "null id", "a"), (2, long, "b"), (2, "other", "c"), (2, "other", "c"), (5, None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, said string")
    got = wn.against_next(df).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["n_chars"]) for r in got) == [(False, None, 7), (True, 2, 5), (True, 2, 5), (True, 2, len(long)), (True, 5, 0)]
    last = next(r for r in got if r["doc_id"] == 5)
    assert (last["near_edited"], last["near_next"], last["fingerprint"]) == (1.0, 0.0, "")
    assert wn.against_next(df.limit(0)).collect() == []
    alone = wn.against_next(df.where("doc_id = 5")).collect()
    assert [(r["n_chars"], r["near_next"]) for r in alone] == [(0, 1.0)]
    named = spark.createDataFrame([("b", "x" * 50), ("a", "x" * 50)], "k string, t string")
    assert sorted(r["near_next"] for r in wn.against_next(named, "k", "t").collect()) == [1.0, 1.0]


def test_shared_runs(spark):
    pick = random.Random(4)
    common = "".join(pick.choice("abcdefghijkl") for _ in range(40))
    left = wn.fingerprints(spark.createDataFrame([(1, "0123456789" + common), (2, None)], "doc_id long, text string"))
    right = wn.fingerprints(spark.createDataFrame([(7, common), (8, "nothing of it")], "doc_id long, text string"))
    found = wn.shared_runs(left, right).collect()
    assert found and {(r["left_key"], r["left_place"] - r["right_place"], r["right_key"]) for r in found} == {(1, 10, 7)}
    with pytest.raises(ValueError):
        wn.fingerprints(left, w=256)
