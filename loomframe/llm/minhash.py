"""Near-duplicate documents by SuperMinHash, banding, verification on full sets and union-find.

SuperMinHash lets every shingle go through the components in an order of its own, a random
permutation, and adds its rank there to its random value; all shingles of a document do one rank at a
time, and a document is done as soon as no later rank can change a component (for all but short texts
after the first or second). Equal sets are one node from the start. Sets that agree in a band of the
signature are candidates; connected candidates are verified together, on whole sets, by tasks of
bounded size: a large group is cut into tiles that are each compared within themselves and with the
group's first set, and only what this has not linked is compared with the other tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomframe.llm.common import BASE, Memo, cut_lineage, run_hashes, slices, word_hash
from loomframe.llm.components import Forest, components

#: Defaults of near-duplicates: shingles of five words, similarity in percent.
SHINGLE, PERCENT = 5, 80
#: Components per band, and the chance to miss a pair just at the threshold.
BAND_ROWS, MISS = 4, 1e-5
#: Shingles in a tile of a group; its sets take eight bytes each.
TILE = 1_000_000

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def bands_for(percent: int) -> int:
    """Bands that are needed so that a pair at the threshold is missed with probability ``MISS`` at most."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** BAND_ROWS)))


def _mixed(x: np.ndarray, step: int) -> np.ndarray:
    x = x + np.uint64(int(BASE) * (step + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def super_minhash(items: np.ndarray, doc: np.ndarray, docs: int, size: int) -> np.ndarray:
    """Signatures (docs x size) of sets of 64-bit hashes; ``doc`` is the document of each item."""
    signature = np.full(docs * size, np.inf)
    perm = None
    for rank in range(size):
        bits = _mixed(items, rank)
        value = (bits >> np.uint64(32)).astype(np.float64) / 2.0**32 + rank
        pick = rank + (((bits & np.uint64(0xFFFFFFFF)) * np.uint64(size - rank)) >> np.uint64(32)).astype(np.int64)
        if rank == 0:
            target, first = pick, pick
        else:
            rows = np.arange(len(items))
            target = perm[rows, pick].astype(np.int64)
            perm[rows, pick] = perm[rows, rank]
        np.minimum.at(signature, doc * size + target, value)
        reach = np.floor(signature.reshape(docs, size).max(1))  # infinite where a component is empty
        open_items = reach[doc] > rank
        if not open_items.any():
            break
        if rank == 0:
            items, doc, first = items[open_items], doc[open_items], first[open_items]
            perm = np.tile(np.arange(size, dtype=np.uint16), (len(items), 1))
            perm[np.arange(len(items)), first] = 0  # the first swap; what it moved to the front is not read again
        elif not open_items.all():
            items, doc, perm = items[open_items], doc[open_items], perm[open_items]
    return signature.reshape(docs, size)


def shingle_sets(texts: list[str | None], hashes: Memo, shingle: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text, ASCII letters in lower case.

    A text with fewer words than a shingle has one, of all its words; one without words has none.
    """
    found = [(t or "").encode().lower().split() for t in texts]
    counts = np.array([len(w) for w in found], np.int64)
    words = np.fromiter((hashes[w] for ws in found for w in ws), np.uint64, int(counts.sum()))
    runs = run_hashes(words, shingle, BASE) if len(words) else words
    runs = _mixed(runs, 1)
    out, start = [], 0
    for n in counts.tolist():
        if n >= shingle:
            out.append(np.unique(runs[start : start + n - shingle + 1]))
        else:
            short = xxhash.xxh64_intdigest(words[start : start + n].tobytes(), n + 1)
            out.append(np.array([short] if n else [], np.uint64))
        start += n
    return out


def _bands(signatures: np.ndarray) -> np.ndarray:
    """One hash per band, different for different bands."""
    docs, size = signatures.shape
    parts = signatures.view(np.uint64).reshape(docs, size // BAND_ROWS, BAND_ROWS)
    folded = np.zeros(parts.shape[:2], np.uint64) + np.arange(parts.shape[1], dtype=np.uint64)
    for i in range(BAND_ROWS):
        folded = _mixed(folded ^ parts[:, :, i], i)
    return folded.view(np.int64)


def _signed(sets: list[np.ndarray], bands: int) -> np.ndarray:
    if not sets:
        return np.empty((0, bands), np.int64)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate(sets)
    return _bands(super_minhash(items, doc, len(sets), bands * BAND_ROWS))


def signatures(df: DataFrame, key: str, text: str, shingle: int, bands: int) -> DataFrame:
    """``key, n_shingles, set_id, bands`` of each whole text; the last two are null for empty sets."""
    schema = T.StructType(
        [df.select(key).schema[0], T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.BinaryType()),
         T.StructField("bands", T.ArrayType(T.LongType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hash()
        for batch in slices(batches, "__text"):
            sets = shingle_sets(batch.column("__text").to_pylist(), hashes, shingle)
            used = [i for i, s in enumerate(sets) if len(s)]
            table: list = [None] * len(sets)
            for i, row in zip(used, _signed([sets[i] for i in used], bands)):
                table[i] = row
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array(table, pa.list_(pa.int64())),
                ],
                schema.names,
            )

    return df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(run, schema)


class Group:
    """Sets that are verified together; links are found between sets that share a band."""

    def __init__(self, sets: list[np.ndarray], percent: int, bands: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets])
        self.forest = Forest(len(sets))
        self.bands = _signed(sets, bands)
        self.tested: set[tuple[int, int]] = set()

    def link(self, x: int, others: list[int]) -> None:
        """Join ``x`` with all of ``others`` that are similar enough and not yet connected."""
        one, forest = self.sets[x], self.forest
        for start in range(0, len(others), 32):
            at = forest.find(x)
            some = [y for y in others[start : start + 32] if forest.find(y) != at]
            some = [y for y in some if 100 * min(len(one), self.sizes[y]) >= self.percent * max(len(one), self.sizes[y])]
            some = [y for y in some if (min(x, y), max(x, y)) not in self.tested]
            if not some:
                continue
            self.tested.update((min(x, y), max(x, y)) for y in some)
            every = np.concatenate([self.sets[y] for y in some])
            place = np.minimum(np.searchsorted(one, every), len(one) - 1)
            sizes = self.sizes[some]
            both = np.add.reduceat(one[place] == every, np.cumsum(sizes) - sizes, dtype=np.int64)
            for y, n, size in zip(some, both, sizes):
                if 100 * n >= self.percent * (len(one) + size - n):
                    forest.join(x, y)

    def link_all(self, left: np.ndarray | None = None) -> None:
        """Compare sets that share a band; with ``left`` only pairs with at least one of these marked sets."""
        for band in self.bands.T:
            order = np.argsort(band, kind="stable")
            cuts = np.flatnonzero(np.diff(band[order])) + 1
            for group in np.split(order, cuts):
                members = group.tolist()
                if len(members) < 2:
                    continue
                if left is not None:
                    for i in group[left[group]].tolist():
                        self.link(i, [m for m in members if m != i])
                    continue
                for i in range(1, len(members)):
                    self.link(members[i], members[:i])


def _verify(rows: DataFrame, shingle: int, percent: int, bands: int) -> DataFrame:
    """Edges ``a, b`` within units: rows ``unit, key, label, left, text``.

    Rows of equal label are known to be connected. If ``left`` is not null anywhere in a unit, only
    pairs with a row whose ``left`` is true are compared.
    """

    def solve(unit: list[tuple], hashes: Memo) -> list[tuple[int, int]]:
        keys = [r[0] for r in unit]
        sets = shingle_sets([r[3] for r in unit], hashes, shingle)
        group = Group(sets, percent, bands)
        head: dict[int, int] = {}
        for i, r in enumerate(unit):
            if r[1] is not None and head.setdefault(r[1], i) != i:
                group.forest.join(i, head[r[1]])
        same: dict[int, int] = {}
        for i, k in enumerate(keys):
            if same.setdefault(k, i) != i:
                group.forest.join(i, same[k])
        group.forest.joined.clear()
        if any(r[2] is not None for r in unit):
            group.link_all(np.array([bool(r[2]) for r in unit]))
        else:
            group.link_all()
        return [(keys[x], keys[y]) for x, y in group.forest.joined if keys[x] != keys[y]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, current, unit = word_hash(), None, []

        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in slices(batches, "text"):
            found = []
            for of, *row in zip(*[batch.column(c).to_pylist() for c in ("unit", "key", "label", "left", "text")]):
                if of != current:
                    if len(unit) > 1:
                        found += solve(unit, hashes)
                    current, unit = of, []
                unit.append(tuple(row))
            if found:
                yield out(found)
        if len(unit) > 1:
            yield out(solve(unit, hashes))

    columns = rows.select("unit", "key", "label", "left", "text")
    return columns.repartition("unit").sortWithinPartitions("unit", "key").mapInArrow(run, "a long, b long")


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``key, n_shingles, component, kept`` per key: documents whose shingle sets are ``percent`` similar are linked.

    A component is named by its smallest key, and that document is kept. Keys are integers. Empty sets
    (null and empty texts) are linked with nothing. Rows that repeat a key give one row: each of them
    is grouped by its own text, and the smallest component and largest set count. Rows with a null key
    are left unlinked, with a null component, and kept as one row. Other columns are left behind; join
    the result by key.
    """
    bands = bands_for(percent)
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    signed = cut_lineage(signatures(docs, "key", "text", shingle, bands))
    sets = signed.where("set_id is not null and key is not null").groupBy("set_id").agg(
        F.min("key").alias("key"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    sets = cut_lineage(sets)

    buckets = sets.select("key", "n", F.explode("bands").alias("bucket"))
    leads = buckets.groupBy("bucket").agg(F.min("key").alias("lead"), F.max("key").alias("last")).where("lead <> last").drop("last")
    candidates = components(buckets.join(leads, "bucket").select(F.col("lead").alias("a"), F.col("key").alias("b")))
    member = sets.groupBy("key").agg(F.max("n").alias("n")).join(candidates.withColumnRenamed("node", "key"), "key")
    tiles = member.groupBy("component").agg(
        F.ceil(F.sum("n") / TILE).cast("int").alias("tiles"), F.count(F.lit(1)).alias("members")
    )
    member = cut_lineage(
        member.join(tiles, "component").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
    )

    def units(table: DataFrame) -> DataFrame:
        # the texts move to their keys once, the small table is hashed
        moved = docs.join(table.hint("shuffle_hash"), "key")
        return cut_lineage(_verify(moved, shingle, percent, bands).distinct())

    nothing = F.lit(None).cast("long").alias("label"), F.lit(None).cast("boolean").alias("left")
    lead = (F.col("key") == F.col("component")) & (F.col("tiles") > 1)
    homes = F.when(lead, F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array("tile"))
    first = member.select("key", F.explode(homes).alias("at"), "component").select(
        "key", F.struct("component", "at", F.lit(0).alias("part")).alias("unit"), *nothing
    )
    edges = units(first)
    large = member.where("tiles > 1")
    if not large.isEmpty():
        so_far = components(edges).withColumnRenamed("node", "key").withColumnRenamed("component", "label")
        labelled = large.join(so_far, "key", "left").withColumn("label", F.coalesce("label", "key"))
        heads = labelled.where("key = component").select("component", F.col("label").alias("head"))
        labelled = cut_lineage(labelled.join(heads, "component"))
        loose = labelled.where("label <> head")
        parts = loose.groupBy("component").agg(F.ceil(F.sum("n") / TILE).cast("int").alias("parts"))
        every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        every_tile = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
        right = labelled.join(parts, "component").select(
            "key", "component", "label", F.col("tile").alias("at"), every_part.alias("part"), F.lit(False).alias("left")
        )
        own = F.pmod(F.xxhash64("key", F.lit(1)), F.col("parts")).cast("int")
        left = loose.join(parts, "component").select(
            "key", "component", "label", every_tile.alias("at"), own.alias("part"), F.lit(True).alias("left")
        )
        second = left.unionByName(right).select("key", F.struct("component", "at", "part").alias("unit"), "label", "left")
        edges = edges.unionByName(units(second))
    labels = components(edges)
    named = sets.select("set_id", F.col("key").alias("first")).join(
        labels.withColumnRenamed("node", "first"), "first", "left"
    ).select("set_id", F.coalesce("component", "first").alias("component"))
    found = signed.join(named, "set_id", "left").groupBy("key").agg(
        F.max("n_shingles").alias("n_shingles"), F.min(F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))).alias("component")
    )
    return found.select(
        F.col("key").cast(df.schema[key].dataType).alias(key), "n_shingles", "component",
        F.coalesce(F.col("key") == F.col("component"), F.lit(True)).alias("kept"),
    )
