"""Exact ranked lexical search by sparse ball trees over term impacts.

A document is a sparse vector of whole-number impacts, an item one of whole-number weights, and the
score is their inner product. Every task builds ball trees over its share of the documents: a node
holds the centroid of its documents and the largest distance from it. No document of a node scores
more than the centroid does plus that radius times the norm of the item's weights on terms that the
node's documents hold. Nodes are taken best bound first until none can reach the k-th best score;
documents in the leaves that are left are scored in whole numbers. Bounds are doubles that are
rounded up beyond their error, so pruning never loses a document.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomframe.llm.common import cut_lineage, slices

#: Items that are searched for in one pass over the documents; more take more passes.
ITEMS_PER_PASS = 256
#: Documents, and entries of their vectors, in one tree; a single larger document has a tree of its own.
TREE_ROWS = 16_384
TREE_ENTRIES = 4_000_000
LEAF_ROWS = 64
#: Stands for a null id, which comes after all others.
LAST = (1 << 63) - 1
#: Bytes of a text that are cut into words at a time.
PART_BYTES = 1 << 20
#: Share by which sums of doubles are widened: above the error of adding a million of them.
SLACK = 1e-9

#: Bytes of terms stay, A-Z are lower-cased, all others end a term; so every character from U+0080 on is part of one.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a whole UTF-8 text in order, in lists of bounded size (but for a term longer than that)."""
    text, at = text or b"", 0
    while at < len(text):
        end = at + PART_BYTES
        part = text[at:end].translate(_FOLD)
        while end < len(text) and part[-1:] != b" ":
            more = text[end : end + 4096].translate(_FOLD)
            cut = more.find(b" ")
            part += more if cut < 0 else more[: cut + 1]
            end += len(more) if cut < 0 else cut + 1
        yield part.split()
        at = end


@dataclass(frozen=True)
class Query:
    """Numbers of the terms that an item holds, and their weights."""

    terms: np.ndarray
    weights: np.ndarray


class Best:
    """The k best of the documents offered: higher scores first, equal ones by ascending id, null ids last."""

    def __init__(self, k: int):
        self.k, self.kept = k, []

    def admits(self, bound: float, least: int) -> bool:
        """May documents with scores up to ``bound`` and ids from ``least`` on be among the best?"""
        return len(self.kept) < self.k or (bound, -least) > self.kept[0][:2]

    def offer(self, score: int, key: int | None) -> None:
        entry = (score, -(LAST if key is None else key), key)
        if len(self.kept) < self.k:
            heapq.heappush(self.kept, entry)
        elif entry[:2] > self.kept[0][:2]:
            heapq.heapreplace(self.kept, entry)

    def floor(self) -> int:
        """Lowest score that can still be admitted."""
        return self.kept[0][0] if len(self.kept) == self.k else 1


def _entries(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each of several runs, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class BallTree:
    """A ball tree over sparse rows of positive whole numbers; rows must not be empty."""

    def __init__(self, keys: list[int | None], sizes: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.keys, self.width = keys, width
        self.order = np.arange(len(sizes))
        self._sizes, self._columns, self._values = sizes, columns, values
        self._starts = np.cumsum(sizes) - sizes
        self._ids = np.array([LAST if k is None else k for k in keys], np.int64)
        norms = np.add.reduceat(values.astype(float) ** 2, self._starts)
        self.spans, self.kids, self.radii, self.least = [], [], [], []
        centres: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = [(0, len(sizes), None)]
        while waiting:
            low, high, parent = waiting.pop()
            node = len(self.spans)
            if parent is not None:
                self.kids[parent].append(node)
            rows, flat = self.order[low:high], self._flat(low, high)
            mean = np.bincount(columns[flat], weights=values[flat], minlength=width) / (high - low)
            held = np.flatnonzero(mean)
            centres.append((held, mean[held]))
            away = self._distances(rows, flat, mean, norms)
            self.spans.append((low, high))
            self.kids.append([])
            self.radii.append(math.sqrt(away.max()))
            self.least.append(int(self._ids[rows].min()))
            if high - low > LEAF_ROWS:
                middle = self._split(low, high, rows, flat, away, norms)
                if middle:
                    waiting += [(low, middle, node), (middle, high, node)]
        self._by_column(centres)
        flat = self._flat(0, len(sizes))
        self._columns, self._values = columns[flat], values[flat]
        self._sizes = sizes[self.order]
        self._starts = np.cumsum(self._sizes) - self._sizes

    def _flat(self, low: int, high: int) -> np.ndarray:
        rows = self.order[low:high]
        return _entries(self._starts[rows], self._sizes[rows])

    def _distances(self, rows: np.ndarray, flat: np.ndarray, point: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Squared distances of rows to a point, rounded up."""
        sizes = self._sizes[rows]
        inner = np.add.reduceat(self._values[flat] * point[self._columns[flat]], np.cumsum(sizes) - sizes)
        total = norms[rows] + point @ point
        return np.maximum(total - 2 * inner, 0) + SLACK * total

    def _split(self, low: int, high: int, rows, flat, away, norms) -> int | None:
        """Order the rows of a node by two far rows that they are nearer to; where the second part begins."""

        def point(row: int) -> np.ndarray:
            at = slice(self._starts[row], self._starts[row] + self._sizes[row])
            dense = np.zeros(self.width)
            dense[self._columns[at]] = self._values[at]
            return dense

        one = self._distances(rows, flat, point(rows[away.argmax()]), norms)
        two = self._distances(rows, flat, point(rows[one.argmax()]), norms)
        if one.max() <= 2.5 * SLACK * norms[rows].max():  # copies of one row
            return None
        lean = one - two
        sort = np.argsort(lean, kind="stable")
        self.order[low:high] = rows[sort]
        count = high - low
        return low + min(max(int((lean < 0).sum()), count // 8), count - count // 8)

    def _by_column(self, centres: list[tuple[np.ndarray, np.ndarray]]) -> None:
        column = np.concatenate([held for held, _ in centres])
        sort = np.argsort(column, kind="stable")
        self._node_of = np.repeat(np.arange(len(centres)), [len(held) for held, _ in centres])[sort]
        self._mean_of = np.concatenate([mean for _, mean in centres])[sort]
        self._column_at = np.searchsorted(column[sort], np.arange(self.width + 1))
        self.radii = np.array(self.radii)

    def bounds(self, query: Query) -> np.ndarray:
        """For each node, a number that no inner product of its rows with the query is above."""
        starts = self._column_at[query.terms]
        sizes = self._column_at[query.terms + 1] - starts
        flat = _entries(starts, sizes)
        weights = np.repeat(query.weights.astype(float), sizes)
        nodes = self._node_of[flat]
        centre = np.bincount(nodes, weights=weights * self._mean_of[flat], minlength=len(self.radii))
        norm = np.sqrt(np.bincount(nodes, weights=weights**2, minlength=len(self.radii)))
        return (centre + norm * self.radii) * (1 + 4 * SLACK)

    def search(self, query: Query, best: Best) -> int:
        """Offer all rows that may be among the best; gives the number of rows scored."""
        bounds = self.bounds(query)
        dense = np.zeros(self.width, np.int64)
        dense[query.terms] = query.weights
        scored, waiting = 0, [(-bounds[0], 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if -bound < best.floor():
                break
            if not best.admits(-bound, self.least[node]):
                continue
            for kid in self.kids[node]:
                heapq.heappush(waiting, (max(-bounds[kid], bound), kid))
            if not self.kids[node]:
                low, high = self.spans[node]
                at = slice(self._starts[low], self._starts[high - 1] + self._sizes[high - 1])
                products = self._values[at] * dense[self._columns[at]]
                scores = np.add.reduceat(products, self._starts[low:high] - self._starts[low])
                scored += high - low
                for row in np.flatnonzero(scores >= best.floor()):
                    best.offer(int(scores[row]), self.keys[self.order[low + row]])
        return scored


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each whole text: its key, ``n`` terms with repeats, and ``terms``, ``counts`` of those in ``vocabulary``."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = f"{key} long, n long, terms array<int>, counts array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in slices(batches, "__text"):
            sizes, columns, counts, lengths = [0], [], [], []
            for value in batch.column("__text"):
                found, n = Counter(), 0
                for words in terms(value.as_py()):
                    n += len(words)
                    found.update(map(number, words))
                found.pop(None, None)
                lengths.append(n)
                columns += found.keys()
                counts += found.values()
                sizes.append(len(columns))
            at = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__key"), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(columns, pa.int32())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))],
                [key, "n", "terms", "counts"],
            )

    given = docs.select(F.col(key).cast("long").alias("__key"), F.col(text).cast("binary").alias("__text"))
    return given.mapInArrow(run, schema)


def _impacts(lengths: np.ndarray, sizes: np.ndarray, counts: np.ndarray, documents: int, total: int) -> np.ndarray:
    damping = np.array([10 + 90 * n * documents // total for n in lengths.tolist()], np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 8 * np.repeat(damping, sizes))


def _trees(batches: Iterable[pa.RecordBatch], key: str, documents: int, total: int, width: int) -> Iterator[BallTree]:
    """Trees over all documents with a term of the vocabulary."""

    def grow(parts: list[tuple]) -> BallTree:
        keys = [k for part in parts for k in part[0]]
        lengths, sizes, columns, counts = (np.concatenate([part[i] for part in parts]) for i in range(1, 5))
        return BallTree(keys, sizes, columns, _impacts(lengths, sizes, counts, documents, total), width)

    waiting, rows, entries = [], 0, 0
    for batch in batches:
        ends = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
        group = (ends - 1) // TREE_ENTRIES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            part = batch.slice(low, high - low)
            sizes = part.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            kept = sizes > 0
            if not kept.any():
                continue
            if waiting and (rows + kept.sum() > TREE_ROWS or entries + sizes.sum() > TREE_ENTRIES):
                yield grow(waiting)
                waiting, rows, entries = [], 0, 0
            waiting.append((
                [k for k, has in zip(part.column(key).to_pylist(), kept) if has],
                part.column("n").to_numpy(zero_copy_only=False)[kept], sizes[kept],
                part.column("terms").flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                part.column("counts").flatten().to_numpy(zero_copy_only=False),
            ))
            rows, entries = rows + int(kept.sum()), entries + int(sizes.sum())
    if waiting:
        yield grow(waiting)


def _passes(items: DataFrame, item: str, text: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their distinct terms, so many at a time; the driver holds no more of them."""
    waiting = []
    for row in items.select(F.col(item).alias("item"), F.col(text).cast("binary").alias("text")).toLocalIterator():
        said = {t for part in terms(bytes(row["text"]) if row["text"] is not None else None) for t in part}
        waiting.append((row["item"], sorted(said)))
        if len(waiting) == ITEMS_PER_PASS:
            yield waiting
            waiting = []
    if waiting:
        yield waiting


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each item: ``item, rank, key, score``.

    Terms, weights and impacts are those of the ``op12`` contract; counts cover all documents, also
    those without any term. Rows of ``docs`` are documents of their own, also where rows or ids
    repeat; ids are whole numbers, equal scores go by ascending id, a null id comes last. Null and
    empty texts hold no term and are never found. Every row of ``items`` is ranked, so repeated items
    have repeated ranks; an item without terms or without matches has no row, an empty table gives an
    empty table. Other columns are left behind.

    Items go in passes of ``ITEMS_PER_PASS``, each one job over all texts: the driver and the tasks
    hold the terms of one pass. A task gives ``k`` rows an item, whatever the number of documents.
    """
    spark = docs.sparkSession
    kind = items.schema[item].dataType.simpleString()
    found = None
    for asked in _passes(items, item, item_text):
        words = sorted({t for _, said in asked for t in said})
        vocabulary = {t: i for i, t in enumerate(words)}
        counted = cut_lineage(count_terms(docs, vocabulary, key, text))
        documents, total = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = np.zeros(len(words), np.int64)
        for number, n in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            holding[number] = n
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in holding.tolist()], np.int64)
        queries = []
        for _, said in asked:
            numbers = np.array([vocabulary[t] for t in said], np.int64)
            numbers = numbers[holding[numbers] > 0]
            queries.append(Query(numbers, weights[numbers]))
        shared = spark.sparkContext.broadcast(queries)
        width = len(words)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = [Best(k) for _ in shared.value]
            for tree in _trees(batches, key, documents, total, width):
                for query, top in zip(shared.value, best):
                    if len(query.terms):
                        tree.search(query, top)
            rows = [(i, score, doc) for i, top in enumerate(best) for score, _, doc in top.kept]
            if rows:
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["__at", "score", key])

        tops = counted.mapInArrow(run, f"__at long, score long, {key} long")
        order = Window.partitionBy("__at").orderBy(F.desc("score"), F.asc_nulls_last(key))
        ranked = tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, of) for i, (of, _) in enumerate(asked)], f"__at long, {item} {kind}")
        part = cut_lineage(ranked.join(F.broadcast(names), "__at").select(item, "rank", key, "score"))
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], f"{item} {kind}, rank int, {key} long, score long")
