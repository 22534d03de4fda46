import math
import random
import re

import numpy as np
import pytest

from loomframe.llm import outliers as ol

GROUPS = ["lang", "source"]


def count(text):
    words = [w.decode() for w in (text or "").encode().split()]
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {p for places in windows.values() if len(places) > 1 for i in places for p in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def sample(seed, size=300):
    pick = random.Random(seed)
    rows = []
    for k in range(size):
        words = [pick.choice("abcdefghijklmnopqrstuvwxyz") * pick.randint(1, 3) + str(pick.randint(0, 40)) for _ in range(pick.randint(0, 260))]
        kind = pick.random()
        if kind < 0.08:
            words = [w + "###" for w in words]
        elif kind < 0.14:
            words = [w for w in words[:30] for _ in range(5)]
        elif kind < 0.18:
            words = [w * 12 for w in words]
        text = "".join(w + pick.choice([" ", " ", " ", "\n", "\t", "  "]) for w in words)
        rows.append((k, text, pick.choice(["en", "de", None]), pick.choice(["s0", "s0", "s1", None])))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("seed", range(2))
def test_statistics(spark, seed):
    rows = sample(seed) + [(900, None, None, None), (901, "", None, None), (902, " \n ", None, None), (903, "a b c", None, None),
                           (904, "a a a a", None, None), (905, "x\n\nx\n \nx y", None, None), (906, " w v", None, None)]
    got = ol.statistics(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert {r["doc_id"]: tuple(r[c] for c in ol.STATISTICS) for r in got} == {r[0]: count(r[1]) for r in rows}


def test_long_text(spark):
    text = " ".join(f"w{i % 7000}" for i in range(20_000))
    got = ol.statistics(spark.createDataFrame([(1, text, "en", "s")], SCHEMA)).first()
    assert tuple(got[c] for c in ol.STATISTICS) == count(text)


def vector(s):
    n = max(s[0], 1)
    return np.array([math.log1p(s[1] / n), math.sqrt(s[2] / n), math.sqrt(s[3] / math.sqrt(n)) * 0.5, math.sqrt(s[4] / n)])


def at_share(bins, share):
    bins = sorted(bins)
    return bins[math.ceil(share * len(bins) - 1e-9) - 1]


def run_of(x, mean, scatter, steps):
    """Concentration steps from one start: mean, scatter and logarithm of the determinant after each."""
    found = []
    for _ in range(steps):
        b = bins(x, mean, scatter)
        core = x[b <= at_share(b.tolist(), ol.CORE)]
        mean = core.mean(0)
        scatter = (core - mean).T @ (core - mean) / len(core) + np.diag(np.array(ol.LEAST_SPREAD) ** 2)
        found.append((mean, scatter, np.linalg.slogdet(scatter)[1]))
    return found


def bins(x, mean, scatter):
    z = x - mean
    return np.floor(32 * np.log2((z @ np.linalg.inv(scatter) * z).sum(1) + 1e-6)).astype(int)


def starts(x):
    low, mid, high = (np.array([at_share([math.floor(v * 100) for v in x[:, i]], q) for i in range(4)]) for q in (0.25, 0.5, 0.75))
    spread = np.array(ol.LEAST_SPREAD)
    wide = np.maximum((high - low) / 134.9, spread)
    return [((at + 0.5) / 100, np.diag(s**2)) for at, s in ((mid, wide), (mid, spread), (low, spread), (high, spread))]


def best_of(x, some=None):
    """Minimum covariance determinant of one group, in numpy."""
    ends = [run_of(x, *start, ol.FIRST_STEPS)[-1] for start in (some or starts(x))]
    best = min(ends, key=lambda e: e[2])
    for mean, scatter, logdet in run_of(x, *best[:2], ol.MOST_STEPS):
        if not logdet < best[2] - ol.LEAST_FALL:
            break
        best = mean, scatter, logdet
    return best


def estimate(x):
    mean, scatter, _ = best_of(x)
    middle = at_share(bins(x, mean, scatter).tolist(), 0.5)
    cut = max(2 ** ((middle + 1) / 32) / ol.MEDIAN_4, 1) * ol.CUT_4
    return lambda v: ((v - mean) @ np.linalg.inv(scatter) @ (v - mean)) / cut


def test_verdicts_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(ol, "LEAST_ROWS", 40)
    rows = sample(7, 500)
    stats = ol.cut_lineage(ol.statistics(spark.createDataFrame(rows, SCHEMA)).drop("text"))
    got = {r["doc_id"]: r for r in ol.judge(stats, ol.fit(stats, GROUPS), GROUPS).collect()}
    counts = {r[0]: count(r[1]) for r in rows}
    failed = {k: c[0] < 50 or 100 * c[4] > 50 * c[0] for k, c in counts.items()}
    members = {}
    for k, _, lang, source in rows:
        if not failed[k]:
            for key in (("fine", lang, source), ("wide", lang), ("all",)):
                members.setdefault(key, []).append(vector(counts[k]))
    models = {key: estimate(np.array(v)) for key, v in members.items() if len(v) >= 40 or key == ("all",)}
    rejected = 0
    for k, _, lang, source in rows:
        assert got[k]["base_failed"] == failed[k]
        if failed[k]:
            assert not got[k]["kept"]
            continue
        model = next(models[key] for key in (("fine", lang, source), ("wide", lang), ("all",)) if key in models)
        want = model(vector(counts[k]))
        assert got[k]["distance"] == pytest.approx(want, rel=1e-4, abs=1e-6)
        assert got[k]["kept"] == (want <= 1)
        rejected += want > 1
    assert rejected > 10


def masked(rng, clean=420, far=138):
    """A tight cluster of nearly a quarter of the rows: a start at the upper quartiles is caught by it."""
    good = np.column_stack([rng.normal(at, 0.15, clean) for at in (1.6, 0.5, 0.4, 0.3)])
    bad = np.column_stack([rng.normal(at, sd, far) for at, sd in ((2.4, 0.02), (1.3, 0.02), (0.8, 0.02), (0.57, 0.01))])
    return np.abs(np.vstack([good, bad])), clean


def counts_of(v, k):
    """Statistics of a document that has about this vector."""
    n = 400
    return (k, "en", "s", n, round(math.expm1(v[0]) * n), round(v[1] ** 2 * n), round((v[2] * 2) ** 2 * math.sqrt(n)), min(190, round(v[3] ** 2 * n)))


def test_several_starts_find_a_masked_cluster(spark):
    names = ["doc_id", "lang", "source", *ol.STATISTICS]
    for seed in range(2):
        x, clean = masked(np.random.default_rng(seed))
        rows = [counts_of(v, k) for k, v in enumerate(x)]
        exact = np.array([vector(r[3:]) for r in rows])
        alone = [best_of(exact, [start])[2] for start in starts(exact)]
        assert max(alone) > min(alone) + 0.5  # a start fails alone
        stats = ol.cut_lineage(spark.createDataFrame(rows, ", ".join(f"{n} {'string' if n in GROUPS else 'long'}" for n in names)))
        found = ol.fit(stats, GROUPS)
        assert found.where("g = 'all'").first()["logdet"] == pytest.approx(min(alone), abs=0.05)
        verdicts = {r["doc_id"]: r["kept"] for r in ol.judge(stats, found, GROUPS).collect()}
        assert sum(verdicts[k] for k in range(clean)) > 0.98 * clean and not any(verdicts[k] for k in range(clean, len(rows)))


def test_small_empty_and_clashing_tables(spark):
    few = spark.createDataFrame([(1, "a b c " * 30, "en", "s", 5), (2, None, None, None, 6), (2, None, None, None, 6)], SCHEMA + ", n_words int")
    stats = ol.cut_lineage(ol.statistics(few))
    got = ol.judge(stats, ol.fit(stats, GROUPS), GROUPS).orderBy("doc_id").collect()
    assert [(r["n_words"], r["base_failed"], r["kept"]) for r in got] == [(90, True, False), (0, True, False), (0, True, False)]
    nothing = ol.cut_lineage(stats.limit(0))
    assert ol.judge(nothing, ol.fit(nothing, GROUPS), GROUPS).collect() == []
    words = " ".join(f"w{i}" for i in range(80))
    one = ol.cut_lineage(ol.statistics(spark.createDataFrame([(1, words, "en", "s")], SCHEMA)))
    assert ol.judge(one, ol.fit(one, GROUPS), GROUPS).first()["kept"]
    assert ol.judge(one, ol.fit(one.limit(0), GROUPS), GROUPS).first()["kept"]


def test_no_python_in_the_plan(spark):
    df = ol.statistics(spark.createDataFrame(sample(1, 20), SCHEMA))
    stats = ol.cut_lineage(df)
    plans = [d._jdf.queryExecution().toString() for d in (df, ol.judge(stats, ol.fit(stats, GROUPS), GROUPS))]
    assert not [p for p in plans if re.search("Python|Arrow|Pandas", p)]
