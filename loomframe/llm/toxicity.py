"""Toxicity from a weighted finite-state grammar over clauses.

Words become symbols: insult (with a learned weight), threat, target, negation, reporting, modal or
other. Small transducers, one per idea, mark the hits of a clause: negated, reported, aimed at someone,
one of a chain of insults, a threat at someone. They are composed into one machine that runs over each
clause with a hit. Which words and stems are insults is learned from labelled rows, and so is what each
mark counts in the score; marks that the rows do not show keep what is set for them beforehand.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomframe.llm.common import Memo, cut_lineage, slices

#: Most labelled rows that are learned from; taken by the hash of their id.
SAMPLE_ROWS = 20_000
#: A word or stem is an insult if so many distinct toxic texts hold it, it is so much likelier there (log), and that is so
#: many standard deviations above chance.
LEAST_TEXTS, LEAST_LOG_ODDS, LEAST_DEVIATIONS = 6, 1.5, 5.0
#: A stem needs so many times the texts of a word, and so many different words that are likelier in toxic texts.
STEM_TEXTS, STEM_WORDS = 3, 3
#: Lengths of stems; a stem stands for all longer words that begin with it.
STEMS = (3, 4, 5, 6)

TARGETS = "you your yours yourself u ur he she him her they them tu te toi vous du dich dir ihr usted vosotros".split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't won't nicht kein keine nie pas jamais nunca tampoco ni".split()
REPORTS = "said says say called calls wrote writes claimed reported quoted sagte dit dijo quote".split()
MODALS = "will gonna shall going i'll werde vais voy".split()
THREATS = "kill hurt destroy beat stab shoot burn murder attack töten umbringen tuer frapper matar golpear".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, MODAL, OTHER = "insult threat target negation report modal other".split()
SYMBOLS = {w: s for s, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (MODAL, MODALS), (THREAT, THREATS)) for w in words}
THREAT_WEIGHT = 4.0
#: Strength of what is expected of the slopes, in rows.
RIDGE = 5.0


@dataclass(frozen=True)
class Transducer:
    """States, steps ``(state, symbol) -> (state, mark)``, and a mark for the state a clause ends in.

    A symbol without a step follows the step for ``"*"`` or keeps the state, without a mark.
    """

    start: str
    steps: dict[tuple[str, str], tuple[str, str]]
    final: dict[str, str] = field(default_factory=dict)

    def step(self, state: str, symbol: str) -> tuple[str, str]:
        return self.steps.get((state, symbol)) or self.steps.get((state, "*")) or (state, "")


def _within(words: int, opener: str, hits: tuple[str, ...], mark: str, again: str | None = None) -> Transducer:
    """Marks hits in so many words after an opener; a hit that is an opener itself (``again``) starts the count anew."""
    states = [str(n) for n in range(words + 1)]
    steps = {(s, opener): (states[-1], mark if again and s != "0" else "") for s in states}
    for before, s in zip(states, states[1:]):
        steps |= {(s, hit): (before, mark) for hit in hits if hit != opener} | {(s, "*"): (before, "")}
    return Transducer("0", steps)


#: Insults and threats in the three words after a negation.
NEGATED = _within(3, NEGATION, (INSULT, THREAT), "negated")
#: Insults that follow another within four words: a sequence of them.
CHAINED = _within(4, INSULT, (), "chained", again=INSULT)
#: Insults and threats after a reporting verb.
REPORTED = Transducer("own", {("own", REPORT): ("other", ""), ("other", INSULT): ("other", "reported"), ("other", THREAT): ("other", "reported")})
#: A clause that names someone.
TARGETED = Transducer("none", {("none", TARGET): ("named", "")}, {"named": "targeted"})
#: A threat is a modal, then a threatening verb, then someone.
THREATENED = Transducer("0", {("0", MODAL): ("m", ""), ("m", THREAT): ("t", ""), ("t", TARGET): ("at", "")}, {"at": "threat"})

GRAMMAR = (NEGATED, CHAINED, REPORTED, TARGETED, THREATENED)


class Machine:
    """The composition of transducers: product states, built as they are met."""

    def __init__(self, *parts: Transducer):
        self.parts = parts
        self.start = tuple(p.start for p in parts)
        self.steps = Memo(self._step, 1 << 16)

    def _step(self, key):
        state, symbol = key
        moved = [p.step(s, symbol) for p, s in zip(self.parts, state)]
        return tuple(s for s, _ in moved), frozenset(m for _, m in moved if m)

    def run(self, clause: list[tuple[str, float]]) -> list[tuple[str, float, frozenset[str]]]:
        """The hits of a clause: symbol, weight and marks, those of the whole clause included."""
        state, hits = self.start, []
        for symbol, weight in clause:
            state, marks = self.steps[state, symbol]
            if weight:
                hits.append((symbol, weight, marks))
        whole = {m for p, s in zip(self.parts, state) if (m := p.final.get(s))}
        return [(symbol, weight, marks | whole) for symbol, weight, marks in hits]


def letters(word: str) -> str:
    return re.sub(r"^\W+|\W+$", "", word)


#: Features of a text, each the logarithm of one more than a sum of weights: of insults, of those with a mark, and of threats.
FEATURES = ("insult", "negated", "reported", "targeted", "chained", "threat")
#: What is expected of the score's slopes before rows are seen, after the constant; rows pull them away from it.
EXPECTED = (-4.0, 2.0, -1.5, -1.0, 0.3, 0.3, 4.0)


@dataclass(frozen=True)
class ToxicModel:
    """Weights of insults (stems end in ``*``) and the logistic curve over the features."""

    weights: dict[str, float]
    curve: tuple[float, ...] = EXPECTED

    def word(self, word: str) -> tuple[str, float, bool]:
        """Symbol, weight, and whether the word ends its clause."""
        core, ends = letters(word), word[-1:] in ".!?;"
        weight = max([self.weights.get(core, 0.0), *[self.weights.get(core[:n] + "*", 0.0) for n in STEMS if len(core) > n]])
        if weight > 0:
            return INSULT, weight, ends
        symbol = SYMBOLS.get(core, OTHER)
        return symbol, THREAT_WEIGHT if symbol == THREAT else 0.0, ends

    def scores(self, features: np.ndarray) -> np.ndarray:
        line = self.curve[0] + np.log1p(features) @ np.array(self.curve[1:])
        return 1 / (1 + np.exp(-np.clip(line, -30, 30)))


class Scorer:
    """Features of a text: weights of its marked hits, clause by clause."""

    def __init__(self, model: ToxicModel, grammar: tuple[Transducer, ...] = GRAMMAR):
        self.words = Memo(model.word)
        self.machine = Machine(*grammar)

    def features(self, text: str | None) -> tuple[float, ...]:
        """Sums in the order of ``FEATURES``. A threatening verb counts only in a threat at someone."""
        sums = dict.fromkeys(FEATURES, 0.0)
        for line in (text or "").lower().split("\n"):
            symbols = [self.words[w] for w in line.split()]
            hits = [i for i, s in enumerate(symbols) if s[1]]
            at = 0
            for hit in hits:
                if hit < at:
                    continue
                start = hit
                while start > at and not symbols[start - 1][2]:
                    start -= 1
                at = hit
                while at < len(symbols) - 1 and not symbols[at][2]:
                    at += 1
                at += 1
                for symbol, weight, marks in self.machine.run([(s, w) for s, w, _ in symbols[start:at]]):
                    if symbol == INSULT:
                        sums["insult"] += weight
                    elif "threat" not in marks:
                        continue
                    for mark in marks:
                        if symbol == THREAT or mark != "threat":
                            sums[mark] += weight
        return tuple(sums.values())


def _labelled(df: DataFrame, labels: DataFrame, key: str, text: str, label: str, where: Column | None, rows: int) -> DataFrame:
    """Distinct labelled texts of a bounded sample; the label table is cut to ``rows`` before the join."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = (known.where(where) if where is not None else known).groupBy(key).agg(F.max(label).alias("__label"))
    known = known.orderBy(F.xxhash64(key), key).limit(rows)
    found = df.select(F.col(key), F.col(text).alias("__text")).where(F.col(text).isNotNull()).join(F.broadcast(known), key)
    return found.select("__text", F.col("__label").cast("int").alias("__label")).dropDuplicates(["__text"])


def learn(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    where: Column | None = None, rows: int = SAMPLE_ROWS,
) -> ToxicModel:
    """Insult weights and the score curve from at most ``rows`` labelled rows.

    ``where`` restricts the label table (on its key). Null keys, labels and texts are left out; of
    rows that repeat a key the highest label counts; equal texts count once, so that a copied text
    does not make its words look toxic. Without usable rows the model knows only threats. What
    reaches the driver is bounded by ``rows``: words found in toxic texts, and six numbers per row.
    """
    sample = _labelled(df, labels, key, text, label, where, rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of = Memo(lambda w: {c, *[c[:n] + "*" for n in STEMS if len(c) > n]} if (c := letters(w)) else set())
        for batch in slices(batches, "__text"):
            found: dict[str, list[int]] = {"": [0, 0]}
            for value, of in zip(batch.column("__text").to_pylist(), batch.column("__label").to_pylist()):
                toxic = 1 if of else 0
                found[""][toxic] += 1
                for k in set().union(*[keys_of[w] for w in set(value.lower().split())]):
                    found.setdefault(k, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), *[pa.array([x[i] for x in found.values()], pa.int64()) for i in (0, 1)]],
                ["word", "clean", "toxic"],
            )

    counts = cut_lineage(
        sample.mapInArrow(count, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    clean, toxic = next(((r["clean"], r["toxic"]) for r in counts.where("word = ''").collect()), (0, 0))
    likelier = (F.col("toxic") > 1) & (F.col("toxic") * F.lit(clean) > F.col("clean") * F.lit(toxic))
    of = counts.where(likelier & (F.col("word") != "") & ~F.col("word").endswith("*"))
    stems = F.explode(F.array(*[F.when(F.char_length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in STEMS]))
    supported = of.select(stems.alias("word")).where(F.col("word").isNotNull()).groupBy("word").count().where(F.col("count") >= STEM_WORDS)
    least = F.when(F.col("word").endswith("*"), LEAST_TEXTS * STEM_TEXTS).otherwise(LEAST_TEXTS)
    known = counts.where((F.col("toxic") >= least) & (F.col("word") != "")).join(supported, "word", "left").where(
        ~F.col("word").endswith("*") | F.col("count").isNotNull()
    )
    weights = {}
    for word, held, found, _ in known.collect():
        odds = math.log((found + 0.5) / (toxic + 1)) - math.log((held + 0.5) / (clean + 1))
        chance = (found + held) * toxic / (clean + toxic)
        if odds >= LEAST_LOG_ODDS and found - chance >= LEAST_DEVIATIONS * math.sqrt(chance):
            weights[word] = round(odds, 6)
    base = ToxicModel(weights)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(base)
        for batch in slices(batches, "__text"):
            rows = [scorer.features(t) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__label"), *[pa.array(c, pa.float64()) for c in zip(*rows)]], ["label", *FEATURES]
            )

    schema = "label int, " + ", ".join(f"{n} double" for n in FEATURES)
    found = sample.mapInArrow(measure, schema).toPandas().sort_values(["label", *FEATURES])  # sums in one order, whatever the tasks
    return ToxicModel(weights, _curve(found[list(FEATURES)].to_numpy(float), found["label"].to_numpy(float) > 0))


def _curve(features: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton's method, held to what is expected by a ridge."""
    expected = np.array(EXPECTED)
    x = np.column_stack([np.ones(len(features)), np.log1p(features)])
    beta = expected.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(beta))
        beta += np.clip(np.linalg.solve(hessian, x.T @ (toxic - p) - RIDGE * (beta - expected)), -2, 2)
    return tuple(beta.tolist())


def score(df: DataFrame, model: ToxicModel, text: str = "text", name: str = "score") -> DataFrame:
    """Add the toxicity score, 0 to 1, of each whole text.

    Null and empty texts and texts without a matched clause get the lowest score. Equal texts score
    alike; only the text is looked at. A column of the same name is replaced, others stay. Memory per
    task: one slice of texts and a word memo.
    """
    df = df.drop(name)
    schema = T.StructType([*df.schema.fields]).add(name, T.DoubleType())
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.curve))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ToxicModel(*shared.value)
        scorer = Scorer(known)
        for batch in slices(batches, text):
            values = known.scores(np.array([scorer.features(t) for t in batch.column(text).to_pylist()]).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], schema.names)

    return df.mapInArrow(run, schema)
