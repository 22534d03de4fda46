"""Near-duplicate vectors by binary codes of random rotations with stored correction factors.

A vector of length one is rotated and kept as the signs of its coordinates, packed to bits, together
with the inner product of the vector and its code, by which an estimate is divided to be unbiased. The
other side of a pair is the rotated vector in sixteen steps, rounded at random, as four planes of bits:
an estimate is four bitwise ands and bit counts. The known spread of the estimate gives a confidence
bound, and only vectors with a pair whose upper bound reaches the threshold are fetched to be compared
exactly, in double precision.

Pairs come from tables of buckets, each keyed by the first bits of a rotation of its own. Buckets hold
codes, factors and planes, a sixth of the vectors' size. How many bits and tables depends on the number
of vectors under a label, so that buckets stay small and a pair just at the threshold is found but for
a chance of ``MISS``. A pair is counted in the first table where it meets. A bucket larger than a tile
is cut, and pairs of tiles are tasks of their own; what leaves a task is vectors to be looked at, one
count per vector and a spanning forest of the links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import cut_lineage
from loomframe.llm.components import Forest, components

THRESHOLD = 0.93
#: Chance that a pair just at the threshold meets in no table.
MISS = 5e-4
#: Vectors of a label per bucket on average, and per tile of a large bucket.
PER_BUCKET, TILE = 16, 2048
#: Planes of bits that the other side of a pair is rounded to, and pairs that a task estimates at a time.
PLANES, PAIRS = 4, 1 << 20
#: Width of the confidence bound, in units of the spread of an estimate.
CONFIDENCE = 4.0
#: Shorter vectors are padded to this many coordinates before they are rotated.
LEAST_BITS = 64


@cache
def rotation(table: int, dim: int) -> np.ndarray:
    """Random orthogonal matrix, the same on every machine; ``dim`` rows, at least ``LEAST_BITS`` columns."""
    size = max(dim, LEAST_BITS)
    q, r = np.linalg.qr(np.random.default_rng([table, size]).standard_normal((size, size)))
    return (q * np.sign(np.diag(r)))[:dim]


def shape(vectors: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Bits per bucket key and number of tables for so many vectors."""
    bits = max(1, min(60, round(math.log2(max(2, vectors) / PER_BUCKET))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISS) / math.log1p(-meet)))


def bucket_keys(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Keys (vectors x tables)."""
    weights = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))
    wide = max(unit.shape[1], LEAST_BITS)
    columns = []
    for table in range(tables):
        # one rotation gives as many keys as it has room for
        per = max(1, wide // bits)
        turned = rotation(1 + table // per, unit.shape[1])[:, table % per * bits : table % per * bits + bits]
        signs = unit @ turned > 0
        columns.append(signs @ weights[: signs.shape[1]])
    return np.column_stack(columns) if columns else np.empty((len(unit), 0), np.int64)


@dataclass(frozen=True)
class Codes:
    """Packed signs and planes (64 coordinates a word), correction factors, and the steps of the planes."""

    signs: np.ndarray  # vectors x words
    factors: np.ndarray
    planes: np.ndarray  # vectors x PLANES x words
    low: np.ndarray
    step: np.ndarray


def _packed(bits: np.ndarray) -> np.ndarray:
    padded = np.zeros((*bits.shape[:-1], -(-bits.shape[-1] // 64) * 64), bool)
    padded[..., : bits.shape[-1]] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view("<u8")


def codes(unit: np.ndarray) -> Codes:
    """Codes of vectors of length one. The rounding of the planes is drawn from the coordinates, so it is the same everywhere."""
    turned = unit @ rotation(0, unit.shape[1])
    factors = np.abs(turned).sum(1) / math.sqrt(turned.shape[1])
    low = turned.min(1)
    step = np.maximum(turned.max(1) - low, 1e-12) / (2**PLANES - 1)
    at = (turned - low[:, None]) / step[:, None]
    drawn = np.abs(np.sin(turned * 1e6)) * 1e4 % 1.0
    whole = np.clip(np.floor(at + drawn), 0, 2**PLANES - 1).astype(np.int64)
    planes = np.stack([_packed(whole >> j & 1 > 0) for j in range(PLANES)], axis=1)
    return Codes(_packed(turned > 0), factors, planes, low, step)


def bounds(size: int, signs: np.ndarray, factors: np.ndarray, planes: np.ndarray, low: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of inner products and their reach, pair by pair: signs and factor of one side, planes of the other.

    ``size`` is the number of rotated coordinates. A code is plus and minus one over the root of it.
    """
    ones = np.bitwise_count(signs).sum(-1).astype(float)
    within = np.zeros(len(signs))
    whole = np.zeros(len(signs))
    for j in range(PLANES):
        within += 2.0**j * np.bitwise_count(signs & planes[:, j]).sum(-1)
        whole += 2.0**j * np.bitwise_count(planes[:, j]).sum(-1)
    product = (2 * (step * within + low * ones) - step * whole - size * low) / math.sqrt(size)
    spread = np.maximum(0, 1 - factors**2) / (size - 1) + step**2 / 4
    return product / factors, CONFIDENCE * np.sqrt(spread) / factors


def links(vectors: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, of ``left`` and of ``right``, whose exact cosine reaches the threshold."""
    norms = np.linalg.norm(vectors, axis=1)
    for start in range(0, len(left), 256):
        some = left[start : start + 256]
        exact = (vectors[some] @ vectors[right].T) / norms[some][:, None] / norms[right]
        at, other = np.nonzero(exact >= threshold)
        yield some[at], right[other]


def _prepared(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``key, group, class, vec``: vectors that can link, as bytes, with an id of their exact value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, classes, kept = [], [], []
            for values, of in zip(batch.column("vec").to_pylist(), batch.column("label").to_pylist()):
                found = None
                if values and of is not None and None not in values:
                    row = np.array(values, np.float64)
                    if np.isfinite(row).all() and 0 < np.linalg.norm(row) < math.inf:
                        found = row.tobytes()
                group = None if found is None else f"{len(values)}:{of}"
                groups.append(group)
                kept.append(found)
                classes.append(None if found is None else xxhash.xxh128_digest(found, xxhash.xxh32_intdigest(group)))
            columns = [batch.column("key"), pa.array(groups, pa.string()), pa.array(classes, pa.binary()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "group", "class", "vec"])

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vec"), F.col(label).cast("string").alias("label"))
    return rows.mapInArrow(run, "key long, group string, class binary, vec binary")


_UNIT = "bucket long, low int, high int"
_CODE = "signs binary, factor double, planes binary, base double, step double"


def _bucketed(classes: DataFrame) -> DataFrame:
    """A row per vector and table with its codes; ``classes`` has the shape of its group in ``bits`` and ``tables``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for (bits, tables, size), part in (
                (k, table.take(rows)) for k, rows in _by(batch, "bits", "tables", pc.binary_length(batch.column("vec")))
            ):
                vectors = np.frombuffer(b"".join(part["vec"].to_pylist()), np.float64).reshape(-1, size // 8)
                unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
                keys, found = bucket_keys(unit, bits, tables), codes(unit)
                groups = part["group"].to_pylist()
                fixed = [
                    part["first"].combine_chunks(), pa.array([len(rotation(0, unit.shape[1])[0])] * len(part), pa.int32()),
                    pa.array([x.tobytes() for x in found.signs], pa.binary()), pa.array(found.factors),
                    pa.array([x.tobytes() for x in found.planes], pa.binary()), pa.array(found.low), pa.array(found.step),
                ]
                for t in range(tables):
                    named = [xxhash.xxh64_intdigest(f"{g}|{t}|{k}") for g, k in zip(groups, keys[:, t].tolist())]
                    columns = [pa.array(np.array(named, np.uint64).view(np.int64)), pa.array([t] * len(part), pa.int32()), *fixed]
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["bucket", "table", "first", "size", "signs", "factor", "planes", "base", "step"]
    return classes.mapInArrow(run, f"bucket long, table int, first long, size int, {_CODE}")


def _involved(tiles: DataFrame, threshold: float) -> DataFrame:
    """Of each unit the vectors with a pair in it whose upper bound reaches the threshold: ``bucket, low, high, tile, table, first``."""
    columns = ["bucket", "low", "high", "tile", "table", "first", "size", "signs", "factor", "planes", "base", "step"]
    kept = columns[:6]

    def judge(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """All pairs of each unit in rows of whole units, at most ``PAIRS`` and one row's at a time."""
        unit = np.stack([rows[c].to_numpy() for c in ("bucket", "low", "high")])
        ends = np.append(np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(0)) + 1, len(rows))
        end_of = np.repeat(ends, np.diff(ends, prepend=0))
        tile, cross = rows["tile"].to_numpy(), rows["low"].to_numpy() != rows["high"].to_numpy()
        sizes = rows["size"].to_numpy()
        involved = np.zeros(len(rows), bool)
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)  # vectors of one length fill whole units
            part = rows.take(own)
            words = -(-size // 64)
            signs = np.frombuffer(b"".join(part["signs"].to_pylist()), "<u8").reshape(-1, words)
            planes = np.frombuffer(b"".join(part["planes"].to_pylist()), "<u8").reshape(-1, PLANES, words)
            factors, low, step = (part[c].to_numpy() for c in ("factor", "base", "step"))
            place = np.full(len(rows) + 1, -1)
            place[own] = np.arange(len(own))
            counts = end_of[own] - own - 1
            cuts = np.flatnonzero(np.diff(np.cumsum(counts) // PAIRS, prepend=0))
            for begin, end in zip([0, *cuts], [*cuts, len(own)]):
                n = counts[begin:end]
                if not n.sum():
                    continue
                one = np.repeat(own[begin:end], n)
                two = one + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                use = ~cross[one] | (tile[one] != tile[two])
                one, two = one[use], two[use]
                a, b = place[one], place[two]
                estimate, reach = bounds(size, signs[a], factors[a], planes[b], low[b], step[b])
                near = estimate + reach >= threshold
                involved[one[near]] = True
                involved[two[near]] = True
        if involved.any():
            yield from rows.select(kept).filter(pa.array(involved)).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "low", "high")])
            begins = np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(0)) + 1
            if last is not None and (unit[:, 0] != last).any():
                begins = np.append(0, begins)
            if len(begins):  # the last unit of a batch may go on in the next
                cut = int(begins[-1])
                yield from judge(pa.Table.from_batches([*waiting, batch.slice(0, cut)]))
                waiting = []
                batch = batch.slice(cut)
            waiting.append(batch)
            last = unit[:, -1]
        if waiting:
            yield from judge(pa.Table.from_batches(waiting))

    sorted_units = tiles.select(columns).repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "first")
    return sorted_units.mapInArrow(run, f"{_UNIT}, tile int, table int, first long")


def _by(batch: pa.RecordBatch, *columns) -> list:
    """Rows of a batch by the values of some columns."""
    lists = [(batch.column(c) if isinstance(c, str) else c).to_pylist() for c in columns]
    groups: dict[tuple, list[int]] = {}
    for row, of in enumerate(zip(*lists)):
        groups.setdefault(of, []).append(row)
    return list(groups.items())


def _linked(tiles: DataFrame, threshold: float) -> DataFrame:
    """``a, b, n``: links found (n null) that span the linked vectors of a unit, or a vector's number of links (b null)."""

    def solve(unit: list[tuple]) -> pa.RecordBatch:
        table, bits, tables = unit[0][3:6]
        vectors = np.frombuffer(b"".join(r[6] for r in unit), np.float64).reshape(len(unit), -1)
        tile = np.array([r[0] for r in unit])
        first, many = np.array([r[1] for r in unit]), np.array([r[2] for r in unit])
        keys = bucket_keys(vectors / np.linalg.norm(vectors, axis=1, keepdims=True), bits, table)
        forest, total = Forest(len(unit)), np.zeros(len(unit), np.int64)
        left, right = np.flatnonzero(tile == tile.min()), np.flatnonzero(tile == tile.max())
        for a, b in links(vectors, left, right, threshold):
            fresh = a < b if len(left) == len(unit) else np.ones(len(a), bool)
            a, b = a[fresh], b[fresh]
            met = np.zeros(len(a), bool)
            for t in range(table):
                met |= keys[a, t] == keys[b, t]
            a, b = a[~met], b[~met]
            np.add.at(total, a, many[b])
            np.add.at(total, b, many[a])
            for x, y in zip(a.tolist(), b.tolist()):
                forest.join(x, y)
        has = np.flatnonzero(total)
        ends = [(int(first[x]), int(first[y])) for x, y in forest.joined]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([e[0] for e in ends] + first[has].tolist(), pa.int64()),
                pa.array([e[1] for e in ends] + [None] * len(has), pa.int64()),
                pa.array([None] * len(ends) + total[has].tolist(), pa.int64()),
            ],
            ["a", "b", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, unit = None, []
        for batch in batches:
            for of, *row in zip(*[batch.column(c).to_pylist() for c in columns]):
                if of != current:
                    if len(unit) > 1:
                        yield solve(unit)
                    current, unit = of, []
                unit.append(tuple(row))
        if len(unit) > 1:
            yield solve(unit)

    columns = ["unit", "tile", "first", "many", "table", "bits", "tables", "vec"]
    return tiles.select(columns).repartition("unit").sortWithinPartitions("unit", "first").mapInArrow(run, "a long, b long, n long")


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """``key, n_links, component, kept`` per row: vectors of one label whose cosine reaches the threshold.

    ``n_links`` counts the other rows that a row is linked with; a component is named by its smallest
    key. A vector that is null, empty, zero or holds null or non-finite numbers, and one with a null
    label, links with nothing; so do vectors of different length. Equal vectors are linked and are
    compared with others once; rows that repeat a key are vectors of their own in one component if
    alike. A null key has a null component and is kept. An empty table gives an empty table; other
    columns are left behind.
    """
    rows = cut_lineage(_prepared(df, key, vector, label))
    classes = rows.where("class is not null and key is not null").groupBy("class", "group", "vec").agg(
        F.min("key").alias("first"), F.count(F.lit(1)).alias("many")
    )
    classes = cut_lineage(classes)
    sizes = classes.groupBy("group").agg(F.count(F.lit(1)).alias("vectors"))

    def per_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = [shape(n, threshold) for n in batch.column("vectors").to_pylist()]
            columns = [batch.column("group"), *[pa.array([s[i] for s in shapes], pa.int32()) for i in (0, 1)]]
            yield pa.RecordBatch.from_arrays(columns, ["group", "bits", "tables"])

    shapes = cut_lineage(sizes.mapInArrow(per_group, "group string, bits int, tables int"))
    buckets = cut_lineage(_bucketed(classes.join(shapes, "group")))
    counts = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "bucket", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")
    )
    tile = F.pmod(F.xxhash64("first"), F.col("tiles")).cast("int")
    tiled = buckets.join(counts, "bucket").withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
    wanted = cut_lineage(_involved(tiled, threshold))
    exact = classes.join(shapes, "group").select("first", "many", "bits", "tables", "vec")
    met = wanted.join(exact, "first").withColumn("unit", F.struct("bucket", "low", "high"))
    found = cut_lineage(_linked(met, threshold))
    total = found.where("n is not null").groupBy(F.col("a").alias("first")).agg(F.sum("n").alias("found"))
    labels = components(found.where("n is null").select("a", "b")).withColumnRenamed("node", "first")
    named = classes.select("class", "first", "many").join(total, "first", "left").join(labels, "first", "left").select(
        "class", (F.col("many") - 1 + F.coalesce("found", F.lit(0))).alias("n_links"), F.coalesce("component", "first").alias("component")
    )
    return rows.select("key", "class").join(named, "class", "left").select(
        F.col("key").cast(df.schema[key].dataType).alias(key),
        F.when(F.col("key").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("key").isNotNull(), F.coalesce("component", "key")).alias("component"),
        F.coalesce(F.col("key") == F.coalesce("component", "key"), F.lit(True)).alias("kept"),
    )
