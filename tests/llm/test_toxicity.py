import math
import random
import re

import numpy as np
import pytest

from loomframe.llm import toxicity as tx
from loomframe.llm.common import crc_fold

CALM = "the a house tree walks slowly under bright evening light and some water runs near old stones".split()


def words(pick, n):
    return [pick.choice(CALM) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(1)
    rows, labels = [], []
    for k in range(500):
        w = words(pick, pick.randint(5, 60))
        toxic = pick.random() < 0.3
        if toxic:
            for _ in range(pick.randint(1, 3)):
                w.insert(pick.randrange(len(w)), pick.choice(["grumbler", "nincompoop,", "Dolt", "krelling" + pick.choice("abcdef")]))
        rows.append((k, " ".join(w) + "."))
        labels.append((k, int(toxic)))
    return rows, labels


def frames(spark, corpus):
    rows, labels = corpus
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_words_and_stems_and_separates_held_out_rows(spark, corpus):
    docs, labels = frames(spark, corpus)
    model = tx.learn(docs, labels, where=tx.F.col("doc_id") % 5 != 0)
    assert {"grumbler", "nincompoop", "dolt", "krelli*"} <= set(model.weights)
    assert not set(CALM) & set(model.weights)
    got = {r["doc_id"]: r["score"] for r in tx.score(docs, model).collect()}
    assert all((got[k] >= 0.5) == bool(toxic) for k, toxic in corpus[1] if k % 5 == 0)
    assert all(0 <= s <= 1 for s in got.values())


def features(text, weights=None, grammar=tx.GRAMMAR):
    found = tx.Scorer(tx.ToxicModel(weights or {"dolt": 4.0}), grammar).features(text)
    return {n: v for n, v in zip(tx.FEATURES, found) if v}


def test_grammar():
    assert features("a dolt sat there.") == {"insult": 4.0}
    assert features("you are a dolt.") == {"insult": 4.0, "targeted": 4.0}
    assert features("a dolt, you see.") == {"insult": 4.0, "targeted": 4.0}
    assert features("this is not a dolt.") == {"insult": 4.0, "negated": 4.0}
    assert features("not so very far from here is a dolt.") == {"insult": 4.0}  # out of the negation's reach
    assert features("someone said dolt.") == {"insult": 4.0, "reported": 4.0}
    assert features("nobody said so. a dolt sat there.") == {"insult": 4.0}  # another clause
    assert features("a dolt of a dolt.") == {"insult": 8.0, "chained": 4.0}
    assert features("a dolt who sat there for a dolt.") == {"insult": 8.0}
    assert features("i will hurt you.") == {"threat": 4.0, "targeted": 4.0}
    assert features("i will never hurt you.") == {"threat": 4.0, "negated": 4.0, "targeted": 4.0}
    assert features("bees hurt.") == features("they will hurt.") == features("a house.") == features(None) == {}
    assert features("DOLT!") == {"insult": 4.0} and features("a dolt. you dolt.") == {"insult": 8.0, "targeted": 4.0}


def test_machine_is_the_product_of_its_parts():
    pick = random.Random(1)
    symbols = [tx.INSULT, tx.THREAT, tx.TARGET, tx.NEGATION, tx.REPORT, tx.MODAL, tx.OTHER]
    for _ in range(200):
        clause = [(s, 1.0 if s in (tx.INSULT, tx.THREAT) else 0.0) for s in pick.choices(symbols, k=pick.randint(0, 9))]
        alone = [tx.Machine(t).run(clause) for t in tx.GRAMMAR]
        assert tx.Machine(*tx.GRAMMAR).run(clause) == [(*hits[0][:2], frozenset().union(*(h[2] for h in hits))) for hits in zip(*alone)]


def brute(rows, labels, rated):
    """Counts, weights, features and scores of the whole operator, one text at a time."""
    label = {}
    for key, value in labels:
        if key is not None and value is not None:
            label[key] = max(value, label.get(key, 0))
    known = {}
    for key, text in rows:
        if text is not None and key in label:
            known.setdefault(text, label[key])
    counts, words = {}, {}
    for text, of in known.items():
        cores = {tx.letters(w) for w in text.lower().split()} - {""}
        for c in cores | {c[:n] + "*" for c in cores for n in tx.STEMS if len(c) > n}:
            counts.setdefault(c, [0, 0])[of] += 1
    clean, toxic = (sum(of == x for of in known.values()) for x in (0, 1))
    for c, (a, b) in counts.items():
        if not c.endswith("*") and b > 1 and b * clean > a * toxic:
            for n in tx.STEMS:
                if len(c) > n:
                    words[c[:n] + "*"] = words.get(c[:n] + "*", 0) + 1
    weights = {}
    for c, (a, b) in counts.items():
        stem = c.endswith("*")
        odds = math.log((b + 0.5) / (toxic + 1)) - math.log((a + 0.5) / (clean + 1))
        chance = (a + b) * toxic / (clean + toxic)
        if b >= 6 * (3 if stem else 1) and (not stem or words.get(c, 0) >= 3) and odds >= 1.5 and b - chance >= 5 * math.sqrt(chance):
            weights[c] = round(odds, 6)
    x = np.array([list(plain_features(t, weights)) for t in known])
    model = tx.ToxicModel(weights, tx._curve(x, np.array(list(known.values())) > 0))
    return weights, [model.scores(np.array([plain_features(t, weights)]))[0] for t in rated]


def plain_features(text, weights):
    """Marks told from distances between words instead of by states."""
    sums = dict.fromkeys(tx.FEATURES, 0.0)
    for clause in re.findall(r"(?:[^.!?;\n\s]+|[.!?;]+(?=\S)|[^\S\n])+[.!?;]*|[.!?;]+", (text or "").lower()):
        kinds = [tx.ToxicModel(weights).word(w)[:2] for w in clause.split()]
        at = {s: [i for i, k in enumerate(kinds) if k[0] == s] for s in (tx.INSULT, tx.TARGET, tx.NEGATION, tx.REPORT)}
        aimed = re.search(f"{tx.MODAL} (.* )?{tx.THREAT} (.* )?{tx.TARGET}", " ".join(k[0] for k in kinds))
        for i, (kind, weight) in enumerate(kinds):
            if kind == tx.INSULT or (kind == tx.THREAT and aimed):
                sums["insult" if kind == tx.INSULT else "threat"] += weight
                sums["targeted"] += weight * bool(at[tx.TARGET])
                sums["reported"] += weight * any(j < i for j in at[tx.REPORT])
                sums["negated"] += weight * any(i - 3 <= j < i for j in at[tx.NEGATION])
                sums["chained"] += weight * (kind == tx.INSULT and any(i - 4 <= j < i for j in at[tx.INSULT]))
    return tuple(sums.values())


def mixed(seed, negated_is_clean):
    pick = random.Random(seed)
    rows, labels = [], []
    for k in range(600):
        w = words(pick, pick.randint(5, 40))
        toxic = negated = False
        if pick.random() < 0.5:
            insult = pick.choice(["dolt", "grumbler", "oaf,", "krelling" + pick.choice("abcdef")])
            negated = pick.random() < 0.4
            put = pick.choice([["not", "a", insult], ["never", insult]]) if negated else pick.choice([["you", insult], [insult], ["said", "he", insult, insult], ["i'll", "hurt", "you", insult]])
            at = pick.randrange(len(w))
            w[at:at] = put
            toxic = not (negated and negated_is_clean)
        rows.append((k, pick.choice([" ", " ", ". ", "\n"]).join([" ".join(w[:7]), " ".join(w[7:])]) + "."))
        labels.append((k, int(toxic)))
    return rows, labels


def test_whole_operator_against_brute_force(spark):
    rows, labels = mixed(3, True)
    rows += [(700, None), (701, ""), (702, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = tx.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r["score"] for r in tx.score(docs, model).collect()}
    weights, scores = brute(rows, labels, [t for _, t in rows])
    assert model.weights == weights and weights
    assert [got[k] for k, _ in rows] == pytest.approx(scores, abs=1e-9)


def test_what_the_marks_count_is_learned(spark):
    rows, labels = mixed(4, True)
    model = tx.learn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    fresh, truth = mixed(5, True)

    def right(grammar):
        scorer = tx.Scorer(model, grammar)
        return sum((model.scores(np.array([scorer.features(t)]))[0] >= 0.5) == bool(y) for (_, t), (_, y) in zip(fresh, truth))

    assert right(tx.GRAMMAR) >= 0.95 * len(fresh) > right(())
    assert right(tx.GRAMMAR) > right(tx.GRAMMAR[1:])  # without negation
    rows, labels = mixed(4, False)
    other = tx.learn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert other.curve[2] > model.curve[2]


def test_clean_sentences_on_the_given_tables(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    model = tx.learn(docs, labels, where=crc_fold("doc_id") != 0)
    scorer = tx.Scorer(model)
    said = ["The pathway was closed.", "Ihre Worte waren klar.", "She loses nothing.", "He is not an idiot.", "Bees kill.", "I will kill you.", "You idiot."]
    assert [s >= 0.5 for s in model.scores(np.array([scorer.features(t) for t in said]))] == [False] * 5 + [True] * 2
    held = tx.score(docs.select("doc_id", "text"), model).join(labels.where((crc_fold("doc_id") == 0) & tx.F.col("toxic").isNotNull()), "doc_id")
    counts = {tuple(r[:2]): r[2] for r in held.groupBy("toxic", (tx.F.col("score") >= 0.5).alias("p")).count().collect()}
    assert counts[1, True] >= 90 and counts.get((0, True), 0) <= 5


def test_edge_cases(spark, corpus):
    docs, labels = frames(spark, corpus)
    more = labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (10_000, 1)], "doc_id long, toxic int")).unionByName(labels)
    model = tx.learn(docs, more)
    long = " ".join(CALM * 4000) + " dolt."
    rows = [(1, None, "x"), (2, "", "x"), (3, "calm house", "x"), (3, "calm house", "x"), (4, long, "x"), (5, "dolt " * 30_000, "x")]
    got = tx.score(spark.createDataFrame(rows, "doc_id long, text string, score string"), model).collect()
    low = min(r["score"] for r in got)
    assert [r["score"] == low for r in sorted(got, key=lambda r: r["doc_id"])] == [True] * 4 + [False] * 2
    assert tx.score(docs.limit(0), model).collect() == []
    unknown = tx.learn(docs, labels.limit(0))
    assert not unknown.weights and all(r["score"] < 0.5 for r in tx.score(docs, unknown).collect())


def test_copies_count_once(spark):
    rows = [(k, "rare word here") for k in range(50)] + [(50 + k, f"calm text {k}") for k in range(50)]
    labels = [(k, int(k < 50)) for k in range(100)]
    model = tx.learn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert not model.weights
