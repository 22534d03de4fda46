"""Batches for trainers: dealt to ranks, written once, and read back in order as one partition per rank."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from loomframe.operators.packing import whole

FORMAT = "trainer_batches"
#: Rows that a reader holds at a time.
ROWS_AT_ONCE = 4_096
_PLACE = ("epoch", "rank", "position")


def deal(df: DataFrame, ranks: int, size: int, position: str = "position") -> DataFrame:
    """Add ``batch`` (``size`` consecutive positions) and ``rank``: batches go round the ranks like cards.

    ``position`` counts from 0 within an epoch, as ``batching.epoch_order`` gives it.
    """
    batch = whole(F.col(position), size)
    return df.withColumn("batch", batch).withColumn("rank", (F.col("batch") % ranks).cast("int"))


def write_batches(dealt: DataFrame, path: str, ranks: int, name: str, replace: bool = False) -> None:
    """Write the dealt rows of one or more epochs under a name, once.

    Rows need ``epoch``, ``rank``, ``batch`` and ``position``, none of them null. Sorted ranges of
    (epoch, rank, batch) are written by as many tasks as Spark makes, so no rank is one task; a batch
    is never cut. A name that is there already is left as it is unless ``replace`` is set.
    """
    dealt.sparkSession.dataSource.register(TrainerBatches)
    rows = dealt.repartitionByRange("epoch", "rank", "batch").sortWithinPartitions(*_PLACE)
    rows.write.format(FORMAT).mode("overwrite" if replace else "append").option("ranks", ranks).option("name", name).save(path)


def read_batches(spark: SparkSession, path: str, rank: int | None = None) -> DataFrame:
    """All published rows: partition r holds those of rank r by epoch and position (one partition for one ``rank``)."""
    spark.dataSource.register(TrainerBatches)
    reader = spark.read.format(FORMAT)
    return (reader if rank is None else reader.option("rank", rank)).load(path)


@dataclass
class Written(WriterCommitMessage):
    files: list[dict] = field(default_factory=list)


@dataclass
class Share(InputPartition):
    files: list[str]


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _load(path: str) -> list[dict]:
    files, root = _place(path)
    listed = files.get_file_info(fs.FileSelector(f"{root}/_manifests", allow_not_found=True))
    found = []
    for info in sorted(listed, key=lambda i: i.path):
        if info.is_file and info.path.endswith(".json"):
            with files.open_input_file(info.path) as source:
                found.append(json.loads(source.read()))
    return found


class TrainerBatches(DataSource):
    """``spark.read.format("trainer_batches")``; options ``path``, ``rank`` (read), ``ranks`` and ``name`` (write)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        found = _load(self.options["path"])
        if not found:
            raise ValueError(f"nothing has been published below {self.options['path']}")
        return T.StructType.fromJson(found[0]["schema"])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        rank = self.options.get("rank")
        return RankReader(self.options["path"], None if rank is None else int(rank))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        missing = {*_PLACE, "batch"} - set(schema.names)
        if missing:
            raise ValueError(f"columns are missing: {sorted(missing)}")
        return RankWriter(self.options["path"], self.options["name"], int(self.options["ranks"]), schema.jsonValue(), overwrite)


class RankReader(DataSourceReader):
    """A partition per rank; its files follow each other by epoch and first position."""

    def __init__(self, path: str, rank: int | None):
        self.path, self.rank = path, rank

    def partitions(self) -> list[Share]:
        found = _load(self.path)
        if len({(m["ranks"], json.dumps(m["schema"])) for m in found}) != 1:
            raise ValueError("what was published differs in its ranks or columns")
        ranks = found[0]["ranks"]
        shares: list[list[dict]] = [[] for _ in range(ranks)]
        for entry in (f for m in found for f in m["files"]):
            shares[entry["rank"]].append(entry)
        for share in shares:
            share.sort(key=lambda f: (f["epoch"], f["first"]))
            for one, other in zip(share, share[1:]):
                if one["epoch"] == other["epoch"] and other["first"] <= one["last"]:
                    raise ValueError(f"epoch {one['epoch']} was published more than once")
        wanted = range(ranks) if self.rank is None else [self.rank]
        return [Share([f["file"] for f in shares[r]]) for r in wanted]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        files, root = _place(self.path)
        for name in partition.files:
            with files.open_input_file(f"{root}/{name}") as source:
                yield from pq.ParquetFile(source).iter_batches(ROWS_AT_ONCE)


class RankWriter(DataSourceArrowWriter):
    """Files that nobody reads until a manifest names them; the manifest is put in its place by one rename.

    Tasks that fail or run twice leave files behind that no manifest names. One job at a time may
    write a name.
    """

    def __init__(self, path: str, name: str, ranks: int, schema: dict, overwrite: bool):
        self.path, self.label, self.ranks, self.kind, self.overwrite = path, name, ranks, schema, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _place(self.path)
        files.create_dir(f"{root}/rows", recursive=True)
        done, writer, entry = Written(), None, None
        try:
            for batch in iterator:
                for part in _runs(batch):
                    epoch, rank, first = (part.column(c)[0].as_py() for c in _PLACE)
                    if entry is None or (entry["epoch"], entry["rank"]) != (epoch, rank):
                        if not 0 <= rank < self.ranks:
                            raise ValueError(f"rank {rank} of {self.ranks}")
                        if writer is not None:
                            writer.close()
                        entry = {"epoch": epoch, "rank": rank, "first": first, "rows": 0, "file": f"rows/{uuid.uuid4().hex}.parquet"}
                        done.files.append(entry)
                        writer = pq.ParquetWriter(f"{root}/{entry['file']}", part.schema, filesystem=files)
                    writer.write_batch(part)
                    entry["rows"] += part.num_rows
                    entry["last"] = part.column("position")[-1].as_py()
        finally:
            if writer is not None:
                writer.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _place(self.path)
        target = f"{root}/_manifests/{self.label}.json"
        there = files.get_file_info(target).is_file
        if there and not self.overwrite:
            return self.abort(messages)
        before = []
        if there:
            with files.open_input_file(target) as source:
                before = json.loads(source.read())["files"]
        files.create_dir(f"{root}/_manifests", recursive=True)
        waiting = f"{root}/_manifests/{uuid.uuid4().hex}.waiting"
        listed = [f for m in messages if m is not None for f in m.files]
        with files.open_output_stream(waiting) as sink:
            sink.write(json.dumps({"ranks": self.ranks, "schema": self.kind, "files": listed}).encode())
        files.move(waiting, target)
        _delete(files, root, before)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _place(self.path)
        _delete(files, root, [f for m in messages if m is not None for f in m.files])


def _delete(files: fs.FileSystem, root: str, entries: list[dict]) -> None:
    for entry in entries:
        files.delete_file(f"{root}/{entry['file']}")


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The stretches of a sorted batch with one epoch and rank."""
    if any(batch.column(c).null_count for c in _PLACE):
        raise ValueError("epoch, rank and position may not be null")
    keys = list(zip(batch.column("epoch").to_pylist(), batch.column("rank").to_pylist()))
    start = 0
    for at in range(1, len(keys) + 1):
        if at == len(keys) or keys[at] != keys[start]:
            yield batch.slice(start, at - start)
            start = at
