"""Removal of long passages that occur earlier in a corpus, by a compacted de Bruijn graph.

Runs of ``window`` words are the edges of the graph. An edge that occurs once needs no attention, so
edges are found in two steps. First each edge is represented by its anchor, the least hash of the
shorter runs inside it (equal edges have equal anchors, and neighbours mostly share theirs): anchors
that occur once in the corpus rule out their edges. Edges with repeated anchors move to their anchor,
neighbours together, and are matched there with their first occurrence; two must agree in the hash
of the anchor and in an independent one of the whole edge, which verifies an edge against the
coordinates of its source. Edges whose sources follow each other in one document are a nonbranching
path and are compacted, within an anchor before they move and then along the document, to one span
with source coordinates, which a join brings back to the text.

Everything that one Python task knows is used before data moves: of equal anchors or edges within a
slice of texts only one row is sent to the key they share, and the others, already known to be
repeated, travel with their document. So a passage in a third of all documents sends one row per
slice, not one per document, to its key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomframe.llm.common import BASE, Memo, run_hashes, slices, sliding_min, word_hash

WINDOW = 20
#: Words of the runs that anchors are chosen from.
ANCHOR = 8

_CHECK = np.uint64(0xD6E8FEB86659FD93)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


class Edges:
    """Edges and anchors of a slice of texts, on one array of all words."""

    def __init__(self, texts: list[str | None], hashes: Memo, window: int, anchor: int):
        found = [(t or "").encode().split() for t in texts]
        self.counts = np.array([len(w) for w in found], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.words = np.fromiter((hashes[w] for words in found for w in words), np.uint64, int(self.counts.sum()))
        n, width = len(self.words), window - anchor + 1
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.place = np.arange(n) - self.starts[self.doc]
        left = self.counts[self.doc] - self.place
        self.window = window
        self.edge = np.flatnonzero(left >= window)  # where an edge starts
        runs = run_hashes(self.words, anchor, BASE) if n else self.words
        runs = (runs ^ (runs >> np.uint64(31))) * _CHECK  # no order that depends on the last word alone
        runs ^= runs >> np.uint64(29)
        self.least = sliding_min(np.where(left >= anchor, runs, _LAST), width) if n else self.words
        chosen = np.zeros(n, bool)
        for step in range(width):
            at = self.edge + step
            chosen[at] |= runs[at] == self.least[self.edge]
        self.anchor_at = np.flatnonzero(chosen)
        self.anchors = runs[self.anchor_at]

    def hashes(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the edges that start at ``at``, independent of those of their anchors."""
        words = (self.words ^ (self.words >> np.uint64(27))) * _CHECK
        return run_hashes(words, self.window, _CHECK | np.uint64(1))[at]


def _repeated_anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """Per document: its anchors that occur more than once in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hash()
        for batch in slices(batches, "__text"):
            ids = batch.column("__key").to_numpy(zero_copy_only=False)
            edges = Edges(batch.column("__text").to_pylist(), hashes, window, anchor)
            values, first, inverse, counts = np.unique(edges.anchors, return_index=True, return_inverse=True, return_counts=True)
            owner = ids[edges.doc[edges.anchor_at]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(owner[first]), pa.nulls(len(values), pa.binary())], ["p", "key", "found"]
            )
            here = counts[inverse] > 1  # known to be repeated without asking others
            order = np.flatnonzero(here)
            cuts = np.flatnonzero(np.diff(edges.doc[edges.anchor_at[order]])) + 1
            groups = np.split(order, cuts) if len(order) else []
            if groups:
                keys = owner[[g[0] for g in groups]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(keys),
                     pa.array([np.unique(edges.anchors[g]).tobytes() for g in groups], pa.binary())],
                    ["p", "key", "found"],
                )

    sent = docs.where("__key is not null").mapInArrow(run, "p long, key long, found binary")
    same = Window.partitionBy("p", F.col("found").isNull()).orderBy("key")
    elsewhere = F.lag("key").over(same).isNotNull() | F.lead("key").over(same).isNotNull()
    repeated = sent.withColumn("again", elsewhere).where(F.col("found").isNotNull() | F.col("again"))
    return repeated.groupBy("key").agg(
        F.collect_list(F.when(F.col("found").isNull(), F.col("p"))).alias("single"), F.collect_list("found").alias("found")
    )


def _spans(joined: DataFrame, window: int, anchor: int) -> DataFrame:
    """Compacted paths of later occurrences: ``key, start, edges, source, source_start``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hash()
        for batch in slices(batches, "__text"):
            batch = batch.filter(pc.is_valid(batch.column("single")))
            if not batch.num_rows:
                continue
            ids = batch.column("__key").to_numpy(zero_copy_only=False)
            edges = Edges(batch.column("__text").to_pylist(), hashes, window, anchor)
            candidates = np.zeros(len(edges.words), bool)
            ends = edges.starts + edges.counts
            for at, (single, found) in enumerate(zip(batch.column("single").to_pylist(), batch.column("found").to_pylist())):
                known = np.concatenate([np.array(single, np.int64).view(np.uint64), *[np.frombuffer(f, np.uint64) for f in found]])
                part = slice(edges.starts[at], ends[at])
                candidates[part] = np.isin(edges.least[part], known)
            at = edges.edge[candidates[edges.edge]]
            if not len(at):
                continue
            hashed, anchored = edges.hashes(at), edges.least[at]
            keys, places = ids[edges.doc[at]], edges.place[at]
            order = np.lexsort((places, keys, hashed, anchored))
            head = np.ones(len(order), bool)
            one, two = anchored[order], hashed[order]
            head[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            origin = order[head][np.cumsum(head) - 1]
            first = np.sort(order[head])  # edges whose first occurrence here is to be compared with other slices
            joint = np.zeros(len(first), bool)
            follows = at[first[1:]] == at[first[:-1]] + 1
            joint[1:] = follows & (anchored[first[1:]] == anchored[first[:-1]]) & (keys[first[1:]] == keys[first[:-1]])
            begin = np.flatnonzero(~joint)
            none = pa.nulls(len(begin), pa.int64())
            offsets = np.append(begin, len(first)).astype(np.int32)
            runs = pa.ListArray.from_arrays(offsets, pa.array(hashed[first].view(np.int64)))
            heads = first[begin]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchored[heads].view(np.int64)), pa.array(keys[heads]), pa.array(places[heads]), runs, none, none, none], names
            )
            later, origin = order[~head], origin[~head]
            apart = (keys[later] != keys[origin]) | (places[later] != places[origin])  # rows of one id are one document
            later, origin = later[apart], origin[apart]
            if not len(later):
                continue
            back = np.lexsort((places[later], keys[later]))
            later, origin = later[back], origin[back]
            k, q, sk, sq = keys[later], places[later], keys[origin], places[origin]
            joint = np.zeros(len(later), bool)
            joint[1:] = (k[1:] == k[:-1]) & (q[1:] == q[:-1] + 1) & (sk[1:] == sk[:-1]) & (sq[1:] == sq[:-1] + 1)
            begin = np.flatnonzero(~joint)
            length = np.diff([*begin, len(later)])
            columns = [k[begin], q[begin], length, sk[begin], sq[begin]]
            key, start, length, source, source_start = (pa.array(np.asarray(c, np.int64)) for c in columns)
            yield pa.RecordBatch.from_arrays(
                [key, key, start, pa.nulls(len(begin), pa.list_(pa.int64())), length, source, source_start], names
            )

    names = ["p", "key", "start", "runs", "edges", "source", "source_start"]
    sent = joined.mapInArrow(run, "p long, key long, start long, runs array<long>, edges long, source long, source_start long")
    # one move by anchor: everything up to the paths of one anchor happens within its partition
    unrolled = sent.repartition("p").select(
        "p", "key", "edges", "source", "source_start", "start", F.posexplode_outer("runs").alias("i", "h")
    ).withColumn("start", F.col("start") + F.coalesce("i", F.lit(0))).drop("i")
    same = Window.partitionBy("p", "h").orderBy("key", "start").rowsBetween(Window.unboundedPreceding, 0)
    later = unrolled.withColumn("origin", F.first(F.struct("key", "start")).over(same)).where(
        F.col("h").isNull() | (F.col("key") != F.col("origin.key")) | (F.col("start") != F.col("origin.start"))
    ).select(
        "p", "key", "start", F.coalesce("edges", F.lit(1)).alias("edges"),
        F.coalesce("source", "origin.key").alias("source"), F.coalesce("source_start", "origin.start").alias("source_start"),
    )
    return _paths(_paths(later, ["p", "key"]), ["key"])


def _paths(edges: DataFrame, by: list[str]) -> DataFrame:
    """Compact edges that follow each other here and in their source to one row."""
    along = Window.partitionBy(*by).orderBy("start")
    follows = (
        (F.lag(F.col("start") + F.col("edges")).over(along) == F.col("start"))
        & (F.lag("source").over(along) == F.col("source"))
        & (F.lag(F.col("source_start") + F.col("edges")).over(along) == F.col("source_start"))
    )
    numbered = edges.withColumn("begins", F.when(follows, 0).otherwise(1)).withColumn("path", F.sum("begins").over(along))
    return numbered.groupBy(*by, "path").agg(
        F.min("start").alias("start"), F.sum("edges").alias("edges"), F.first("source").alias("source"), F.min("source_start").alias("source_start")
    ).drop("path")


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Remove every word covered by a run of ``window`` words that also starts earlier in the corpus.

    Earlier: in a document of smaller key, or before in the same one. Runs are judged on the input.
    Adds ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by one space) and ``spans``
    (removed passages: start and number of words, source key and source start), replacing columns of
    these names. The key is an integer. Rows with a null key stay whole and are no source; null and
    empty texts have no words. Rows that repeat a key count as one document, so neither is earlier
    than the other. Time and memory per task depend on the longest text, not on how often a passage
    repeats.
    """
    if not 0 < anchor < window:
        raise ValueError("an anchor must be shorter than the window")
    names = ["n_words", "n_removed", "kept_text", "spans"]
    df = df.drop(*[c for c in names if c not in (key, text)])
    docs = df.select(F.col(key).cast("long").alias("__key"), F.col(text).alias("__text"))
    known = _repeated_anchors(docs, window, anchor)
    # both joins are outer ones on the same table, so that Spark can move the texts once for both
    joined = docs.join(known.hint("shuffle_hash"), F.col("__key") == F.col("key"), "left").drop("key")
    spans = _spans(joined, window, anchor).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", (F.col("edges") + window - 1).alias("words"), "source", "source_start"))).alias("spans")
    )
    if set(df.columns) == {key, text}:
        found = docs.join(spans.hint("shuffle_hash"), F.col("__key") == F.col("key"), "left").select(
            F.col("__key").cast(df.schema[key].dataType).alias(key), F.col("__text").alias(text), "spans"
        )
    else:
        spans = spans.withColumnRenamed("key", "__of")
        found = df.join(spans.hint("shuffle_hash"), df[key] == F.col("__of"), "left").drop("__of")

    schema = found.drop("spans").schema
    others = schema.names.copy()
    for name, of in (("n_words", "long"), ("n_removed", "long"), ("kept_text", "string")):
        schema = schema.add(name, of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            counts, removed, kept = [], [], []
            for value, gone in zip(batch.column(text).to_pylist(), batch.column("spans").to_pylist()):
                words = (value or "").encode().split()
                counts.append(len(words))
                if gone:
                    stays = np.ones(len(words), bool)
                    for span in gone:
                        stays[span["start"] : span["start"] + span["words"]] = False
                    words = [words[i] for i in np.flatnonzero(stays)]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words).decode())
            added = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), batch.column("spans")]
            yield pa.RecordBatch.from_arrays([*map(batch.column, others), *added], [*others, *names])

    return found.mapInArrow(run, StructType([*schema.fields, found.schema["spans"]]))
