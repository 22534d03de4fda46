"""Winnowed fingerprints of texts, and how alike neighbouring documents are.

Every run of ``k`` characters has a rolling hash; of each ``w`` neighbouring hashes the least one is
kept, the rightmost of equal ones, with its place. Whatever two texts share over ``w + k - 1``
characters or more has a common window, so a common hash, and the places say where. Texts too short for a
window give the least of the hashes they have, texts shorter than a run one hash of all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomframe.llm.common import BASE, cut_lineage, run_hashes, slices
from loomframe.operators.ordering import key_text, literal

#: Characters of a run and runs of a window: anything shared over 31 characters is found.
K, W = 12, 20
#: Characters of one text that are hashed at a time.
PART_CHARS = 1 << 18
#: Bytes of text that a range of documents is to hold.
RANGE_BYTES = 24 << 20
MAX_RANGES = 4_096
SAMPLES_PER_RANGE = 20


def _mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one change of 64-bit numbers after which the order of hashes tells nothing of the texts."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Places of the kept runs, ascending, and their hashes. An empty text has none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    k = min(k, len(codes))
    runs = len(codes) - k + 1
    w = min(w, runs)
    places, hashes, last = [], [], -1
    for low in range(0, runs - w + 1, PART_CHARS):
        windows = min(PART_CHARS, runs - w + 1 - low)
        part = codes[low : low + windows + w - 1 + k - 1]
        found = _mixed(run_hashes(part, k, BASE)[: windows + w - 1])
        backwards = np.lib.stride_tricks.sliding_window_view(found[::-1], w)  # the first least is then the rightmost
        kept = np.unique(np.arange(windows) + (w - 1 - backwards.argmin(axis=1)[::-1]))
        kept = kept[low + kept > last]  # the part before may have kept the first one as well
        last = low + kept[-1] if len(kept) else last
        places.append(low + kept)
        hashes.append(found[kept])
    return np.concatenate(places), np.concatenate(hashes)


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Common share of the different hashes of two fingerprints; two empty ones are alike."""
    one, two = np.unique(one), np.unique(two)
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both / (len(one) + len(two) - both) if len(one) or len(two) else 1.0


def spelled(places: np.ndarray, hashes: np.ndarray) -> str:
    """A fingerprint as hexadecimal text: for each kept run the step from the place before it (two digits; a window is at
    most 255 runs) and the upper half of its hash (eight digits)."""
    record = np.empty(len(places), np.dtype([("step", "u1"), ("hash", ">u4")]))
    record["step"] = np.diff(places, prepend=0)
    record["hash"] = (hashes >> np.uint64(32)).astype(np.uint32)
    return record.tobytes().hex()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of whole texts as arrays: ``key, n_chars, places, hashes`` (64 bits, signed).

    Equal texts have equal fingerprints, whatever their keys. A null or empty text has empty arrays;
    repeated rows stay; other columns are left behind; an empty table gives an empty table.
    """
    if not (0 < k and 0 < w < 256):
        raise ValueError("a run has one character at least, a window 1 to 255 runs")
    schema = T.StructType([
        docs.select(key).schema[0], T.StructField("n_chars", T.LongType()),
        T.StructField("places", T.ArrayType(T.LongType())), T.StructField("hashes", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            texts = [_decoded(v) for v in batch.column("__text")]
            found = [winnow(t, k, w) for t in texts]
            ends = np.cumsum([0, *(len(p) for p, _ in found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__key"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.ListArray.from_arrays(ends, np.concatenate([p for p, _ in found])),
                 pa.ListArray.from_arrays(ends, np.concatenate([h for _, h in found]).view(np.int64))],
                schema.names,
            )

    return docs.select(F.col(key).alias("__key"), F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)


def _decoded(value: pa.Scalar) -> str:
    raw = value.as_buffer()
    return "" if raw is None else raw.to_pybytes().decode("utf-8", "replace")


def shared_runs(left: DataFrame, right: DataFrame, key: str = "doc_id") -> DataFrame:
    """Where texts of two tables of :func:`fingerprints` share kept runs: ``left_key, left_place, right_key, right_place``.

    Every passage of ``w + k - 1`` characters or more that two texts share gives a row. A join on the
    hash, so a run that very many texts hold gives as many rows: use it on selected documents.
    """

    def runs(df: DataFrame, side: str) -> DataFrame:
        at = F.explode(F.arrays_zip("places", "hashes")).alias("at")
        return df.select(F.col(key).alias(f"{side}_key"), at).select(
            f"{side}_key", F.col("at.places").alias(f"{side}_place"), F.col("at.hashes").alias("hash")
        )

    return runs(left, "left").join(runs(right, "right"), "hash").drop("hash")


def _cuts(ids: DataFrame, kind: T.DataType, total: int) -> list[str]:
    """Ids, as text, that cut the sorted documents into ranges of about equal bytes: from a sample of bounded size."""
    ranges = int(min(MAX_RANGES, max(2, -(-total // RANGE_BYTES))))
    sample = ids.withColumn("__at", F.rand(7)).where(
        F.col("__at") * F.lit(float(max(total, 1))) < F.col("bytes") * F.lit(float(ranges * SAMPLES_PER_RANGE))
    )
    found = sample.orderBy("id").select(key_text("id", kind)).collect()
    picked = [found[len(found) * i // ranges][0] for i in range(1, ranges)] if found else []
    return [c for c in dict.fromkeys(picked) if c is not None]


def against_next(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Each text beside the next document's and beside its own edit, by their fingerprints.

    The edit replaces the last quarter of a text (whole code points, rounded down) by the first as many of the next
    document's text, or all of it. Documents go by ascending id, nulls first, then by a digest of the
    text; the first one comes after the last. Returns ``key, n_chars, edited_sha256, fingerprint,
    edited_fingerprint`` (see :func:`spelled`), ``near_edited`` and ``near_next``, one row per row of
    ``docs``. A null text is empty; two empty texts are alike by 1. A single document is its own
    next. Other columns are left behind, and an empty table gives an empty table.

    Texts move once, into ranges of ids; the first document of a range goes to the range before as
    well. A task then streams through its range and holds two texts.
    """
    kind = docs.schema[key].dataType
    given = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("said"))
    ids = cut_lineage(given.select("id", F.xxhash64("said").alias("tie"), F.octet_length("said").cast("long").alias("bytes")))
    cuts = _cuts(ids, kind, ids.agg(F.sum(F.col("bytes") + 64)).first()[0] or 0)
    bounds = F.expr("array(" + ", ".join(literal(c, kind) for c in cuts) + ")") if cuts else None

    def range_of(column: str):
        if bounds is None:
            return F.lit(0)
        # nulls first: in range 0
        steps = [1 << bit for bit in range(len(cuts).bit_length() - 1, -1, -1)]
        found = F.aggregate(
            F.array(*map(F.lit, steps)), F.lit(0),
            lambda at, step: F.when(F.get(F.col("__bounds"), at + step - 1) <= F.col(column), at + step).otherwise(at),
        )
        return F.coalesce(found, F.lit(0))

    def ranged(df: DataFrame) -> DataFrame:
        if bounds is None:
            return df.withColumn("range", F.lit(0))
        return df.withColumn("__bounds", bounds).withColumn("range", range_of("id")).drop("__bounds")

    # the first row of each range, and the range before it that holds any
    firsts = ranged(ids).groupBy("range").agg(F.min(F.struct(F.col("id").isNotNull().alias("some"), "id", "tie")).alias("at")).orderBy("range").collect()
    places = [r["range"] for r in firsts]
    before = {here: places[i - 1] for i, here in enumerate(places)}
    guests = docs.sparkSession.createDataFrame(
        [(r["at"]["id"], r["at"]["tie"], before[r["range"]]) for r in firsts],
        T.StructType([T.StructField("__id", kind), T.StructField("__tie", T.LongType()), T.StructField("__to", T.IntegerType())]),
    )
    own = given.withColumn("tie", F.xxhash64("said"))
    match = F.col("id").eqNullSafe(F.col("__id")) & (F.col("tie") == F.col("__tie"))
    copies = ranged(own.join(F.broadcast(guests), match, "left")).select(
        "id", "tie", "said",
        F.explode(F.array_compact(F.array(
            F.struct("range", F.lit(0).alias("guest")),
            F.when(F.col("__to").isNotNull(), F.struct(F.col("__to").alias("range"), F.lit(1).alias("guest"))),
        ))).alias("place"),
    ).select("place.range", "place.guest", "id", "tie", "said")
    order = ["range", "guest", F.col("id").asc_nulls_first(), "tie"]
    schema = T.StructType([
        T.StructField(key, kind), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
    ])

    def compare(held: tuple, said: str, found: tuple) -> tuple:
        key, text, mine = held
        cut = len(text) // 4
        edited = text[: len(text) - cut] + said[:cut]
        theirs = winnow(edited, k, w)
        return (
            key, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), spelled(*mine), spelled(*theirs),
            likeness(mine[1], theirs[1]), likeness(mine[1], found[1]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in slices(batches, "said"):
            done = []
            for of, guest, id_, value in zip(batch.column("range").to_pylist(), batch.column("guest").to_pylist(), batch.column("id").to_pylist(), batch.column("said")):
                if guest and held is None:
                    continue  # a further copy of the guest
                said = _decoded(value)
                found = winnow(said, k, w)
                if held is not None and at == of:
                    done.append(compare(held, said, found))
                held, at = None if guest else (id_, said, found), of
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, batch.column("id").type) for i, c in enumerate(zip(*done))], schema.names)

    return copies.repartitionById(len(cuts) + 1, "range").sortWithinPartitions(*order).select("range", "guest", "id", "said").mapInArrow(run, schema)
