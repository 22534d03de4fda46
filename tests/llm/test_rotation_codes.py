import math

import numpy as np
import pytest

from loomframe.llm import rotation_codes as rc


def brute(rows, threshold=0.93):
    keys = [r[0] for r in rows]
    n, up = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    def usable(r):
        return r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and np.linalg.norm(r[1]) > 0

    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    n[i] += 1
                    n[j] += 1
                    s, t = find(i), find(j)
                    if keys[s] > keys[t]:
                        s, t = t, s
                    up[t] = s
    return sorted((keys[i], n[i], keys[find(i)], keys[find(i)] == keys[i]) for i in range(len(rows)))


@pytest.mark.parametrize("tile", [2048, 9])
def test_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(rc, "TILE", tile)
    rng = np.random.default_rng(tile)
    rows = []
    for k in range(400):
        if rows and rng.random() < 0.6:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(0, rng.choice([0, 0.02, 0.05]), 64)
        else:
            v = rng.normal(0, 1, 64)
        rows.append((k, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    got = rc.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_edge_cases(spark):
    one = [1.0] * 4
    rows = [(0, one, 1), (1, one, 1), (2, one, 2), (3, one, None), (4, None, 1), (5, [], 1), (6, [0.0] * 4, 1), (7, [1.0, None, 1.0, 1.0], 1),
            (8, [math.nan, 1.0, 1.0, 1.0], 1), (9, [math.inf, 1.0, 1.0, 1.0], 1), (10, [2.0] * 4, 1), (11, [1.0] * 5, 1), (11, [1.0] * 5, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, rc.near_duplicates(df).collect()))
    assert got == [(0, 2, 0, True), (1, 2, 0, False), (2, 0, 2, True), *[(k, 0, k, True) for k in range(3, 10)], (10, 2, 0, False), (11, 1, 11, True), (11, 1, 11, True)]
    assert rc.near_duplicates(df.limit(0)).collect() == []
    null = spark.createDataFrame([(None, one, 1, "x"), (2, one, 1, "y")], "vec_id long, embedding array<double>, label int, vec string")
    assert sorted(map(tuple, rc.near_duplicates(null).collect()), key=repr) == [(2, 0, 2, True), (None, 0, None, True)]


def unit_rows(rng, count, dim):
    x = rng.normal(size=(count, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("dim", [8, 64, 100, 768])
def test_estimates_are_unbiased_and_bounded(dim):
    rng = np.random.default_rng(5)
    x = unit_rows(rng, 400, dim)
    y = x + rng.normal(0, 0.3 / math.sqrt(dim), x.shape)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    a, b = (np.repeat(np.arange(400), 400), np.tile(np.arange(400), 400))
    mine, theirs = rc.codes(x), rc.codes(y)
    size = max(dim, rc.LEAST_BITS)
    assert mine.signs.shape == (400, -(-size // 64)) and mine.signs.dtype == np.uint64
    estimate, reach = rc.bounds(size, mine.signs[a], mine.factors[a], theirs.planes[b], theirs.low[b], theirs.step[b])
    error = estimate - (x @ y.T)[a, b]
    assert abs(error.mean()) < 0.003
    assert (np.abs(error) <= reach).mean() > 0.999
    assert (np.abs(error[a == b]) <= reach[a == b]).all()


def test_buckets_carry_codes_and_not_vectors(spark):
    vectors = unit_rows(np.random.default_rng(1), 50, 768)
    rows = [(f"768:{i % 2}", i, 1, 2, 3, bytearray(v.tobytes())) for i, v in enumerate(vectors)]
    got = rc._bucketed(spark.createDataFrame(rows, "group string, first long, many long, bits int, tables int, vec binary")).collect()
    assert len(got) == 150
    assert all(len(r["signs"]) == 768 // 8 and len(r["planes"]) == 4 * 768 // 8 for r in got)


def test_only_vectors_with_a_pair_in_reach_are_fetched(spark):
    rng = np.random.default_rng(2)
    x = unit_rows(rng, 300, 256)
    x[1] = x[0] + rng.normal(0, 0.01, 256)
    rows = [("256:1", i, 1, 1, 1, bytearray(v.tobytes())) for i, v in enumerate(x)]
    coded = rc._bucketed(spark.createDataFrame(rows, "group string, first long, many long, bits int, tables int, vec binary"))
    units = coded.selectExpr("*", "1L AS one", "0 AS tile", "0 AS low", "0 AS high").drop("bucket").withColumnRenamed("one", "bucket")
    got = {r["first"] for r in rc._involved(units, 0.93).collect()}
    assert {0, 1} <= got and len(got) < 10


def test_shape_grows_slowly():
    tables = [rc.shape(n)[1] for n in (100, 10_000, 1_000_000, 100_000_000)]
    assert tables == sorted(tables) and tables[-1] < 200
