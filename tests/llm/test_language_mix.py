import random
import zlib

import numpy as np
import pytest

from loomframe.llm import language_mix as lm

SPEECH = {"one": "ka lo mi te ru", "two": "bre sto gli fra dun", "three": "xo qui zet wyn jax"}


def text(pick, lang, words):
    syllables = SPEECH[lang].split()
    return " ".join("".join(pick.choices(syllables, k=pick.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(4)
    return [(k, text(pick, lang, pick.randint(5, 60)), lang) for k in range(300) for lang in [pick.choice(list(SPEECH))]]


def test_counts_cover_all_rows(spark, corpus):
    df = spark.createDataFrame([*corpus, (900, None, "one"), (901, "lost", None), (902, "", "two")], "doc_id long, text string, lang string")
    model = lm.learn(df.repartition(7))
    assert model.languages == ["one", "three", "two"]
    want = np.zeros((lm.CELLS, 3))
    for _, t, lang in corpus:
        for word in t.encode().split():
            _, grams, _ = lm.word_cells([word])
            np.add.at(want[:, model.languages.index(lang)], grams, 1)
    assert np.allclose(model.trigrams, np.log(want + lm.SMOOTH).astype(np.float32))


def test_held_out_accuracy_and_mixtures(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string, lang string").repartition(4)
    held = {k for k, _, _ in corpus if zlib.crc32(str(k).encode()) % 5 == 0}
    model = lm.learn(df, where=lm.F.pmod(lm.F.crc32(lm.F.col("doc_id").cast("string").cast("binary")), lm.F.lit(5)) != 0)
    got = {r["doc_id"]: r for r in lm.predict(df, model).collect()}
    assert all(got[k]["lang_pred"] == lang for k, _, lang in corpus if k in held)
    pick = random.Random(5)
    mixed = text(pick, "one", 60) + " " + text(pick, "two", 30)
    row = lm.predict(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()
    assert row["lang_pred"] == "one" and set(row["proportions"]) == {"one", "two"}
    assert abs(row["proportions"]["one"] - 2 / 3) < 0.06


def test_edge_cases(spark, corpus):
    model = lm.learn(spark.createDataFrame(corpus, "doc_id long, text string, lang string"))
    long = text(random.Random(6), "three", 50_000)
    rows = [(1, None, 0.5), (2, "", 0.5), (3, "123 !? \n", 0.5), (4, "KALO mi-te", 0.5), (4, "KALO mi-te", 0.5), (5, long, 0.5), (6, "日本", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = lm.predict(df, model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got[:6]] == ["und", "und", "und", "one", "one", "three"]
    assert all(0 <= r["score"] <= 1 for r in got) and got[6]["lang_pred"] in model.languages
    assert lm.predict(df.limit(0), model).collect() == []
    nothing = lm.learn(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in lm.predict(df, nothing).collect()} == {"und"}


def test_expectation_maximisation_finds_the_best_share():
    rng = np.random.default_rng(7)
    logs, counts = rng.normal(0, 1, (40, 2)), rng.integers(1, 4, 40).astype(float)
    share = lm.mixtures(logs, counts, np.array([0]), rounds=400)[0]

    def fitted(x):
        return (counts * np.log(np.exp(logs) @ [x, 1 - x])).sum() - 0.5 * (0 < x < 1) * np.log(counts.sum())

    assert fitted(share[0]) >= max(fitted(x) for x in np.linspace(0, 1, 101)) - 1e-3
