import random

import pytest
from pyspark.sql import functions as F

from loomframe.operators import batching
from loomframe.sources import trainers

SCHEMA = "id long, note string, marks array<int>"


def rows_of(spark, n):
    return spark.createDataFrame([(i, None if i % 3 else f"text {i}", [i, i + 1]) for i in range(n)], SCHEMA).repartition(5)


def dealt(spark, n, epochs=(1, 2), ranks=3, size=4):
    frames = [batching.epoch_order(rows_of(spark, n), "id", epoch=e) for e in epochs]
    all_of = frames[0]
    for frame in frames[1:]:
        all_of = all_of.unionByName(frame)
    return trainers.deal(all_of, ranks, size)


def by_rank(df):
    """The rows of each partition in the order they are read."""
    place = F.monotonically_increasing_id().alias("at")
    found = df.select(F.spark_partition_id().alias("part"), place, "epoch", "rank", "batch", "position", "id", "note", "marks").collect()
    shares = {}
    for row in sorted(found, key=lambda r: r["at"]):
        shares.setdefault(row["part"], []).append(row)
    return shares


@pytest.mark.parametrize("n", [1, 4, 47, 300])
def test_every_row_goes_to_one_rank_in_order(spark, tmp_path, n):
    path = str(tmp_path / "feed")
    rows = dealt(spark, n)
    trainers.write_batches(rows, path, 3, "both")
    shares = by_rank(trainers.read_batches(spark, path))
    want = sorted((r["epoch"], r["position"], r["id"], r["note"], tuple(r["marks"])) for r in rows.collect())
    got = sorted((r["epoch"], r["position"], r["id"], r["note"], tuple(r["marks"])) for share in shares.values() for r in share)
    assert got == want and len(got) == 2 * n
    for rank, share in shares.items():
        places = [(r["epoch"], r["position"]) for r in share]
        assert places == sorted(places)
        assert all(r["rank"] == rank and r["batch"] == r["position"] // 4 and r["batch"] % 3 == rank for r in share)


def test_one_rank_and_ranks_without_rows(spark, tmp_path):
    path = f"file:{tmp_path}/feed"
    trainers.write_batches(dealt(spark, 10, ranks=8), path, 8, "a")
    whole = trainers.read_batches(spark, path)
    assert whole.rdd.getNumPartitions() == 8
    one = trainers.read_batches(spark, path, rank=2)
    assert one.rdd.getNumPartitions() == 1 and {r["position"] for r in one.collect()} == {8, 9}
    assert trainers.read_batches(spark, path, rank=7).count() == 0


def test_a_name_counts_once_and_may_be_replaced(spark, tmp_path):
    path = str(tmp_path / "feed")
    trainers.write_batches(dealt(spark, 20, epochs=(1,)), path, 3, "epoch-1")
    trainers.write_batches(dealt(spark, 30, epochs=(1,)), path, 3, "epoch-1")
    assert trainers.read_batches(spark, path).count() == 20
    trainers.write_batches(dealt(spark, 20, epochs=(2,)), path, 3, "epoch-2")
    assert trainers.read_batches(spark, path).groupBy("epoch").count().count() == 2
    trainers.write_batches(dealt(spark, 30, epochs=(1,)), path, 3, "epoch-1", replace=True)
    assert trainers.read_batches(spark, path).count() == 50
    listed = len(list((tmp_path / "feed" / "rows").iterdir()))
    named = sum(len(m["files"]) for m in trainers._load(path))
    assert listed == named


def test_overlaps_and_other_ranks_are_refused(spark, tmp_path):
    path = str(tmp_path / "feed")
    trainers.write_batches(dealt(spark, 20, epochs=(1,)), path, 3, "a")
    trainers.write_batches(dealt(spark, 20, epochs=(1,)), path, 3, "b")
    with pytest.raises(Exception, match="more than once"):
        trainers.read_batches(spark, path).count()
    other = str(tmp_path / "other")
    trainers.write_batches(dealt(spark, 20, epochs=(1,)), other, 3, "a")
    trainers.write_batches(dealt(spark, 20, epochs=(2,), ranks=2), other, 2, "b")
    with pytest.raises(Exception, match="differs"):
        trainers.read_batches(spark, other).count()


def test_a_failed_job_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "feed")
    broken = dealt(spark, 40).withColumn("note", F.when(F.col("position") == 37, F.raise_error(F.lit("lost"))).otherwise(F.col("note")))
    with pytest.raises(Exception, match="lost"):
        trainers.write_batches(broken, path, 3, "a")
    with pytest.raises(Exception, match="nothing has been published"):
        trainers.read_batches(spark, path)
    no_place = dealt(spark, 8).withColumn("position", F.when(F.col("position") > 2, F.col("position")))
    with pytest.raises(Exception, match="may not be null"):
        trainers.write_batches(no_place, path, 3, "a")
    trainers.write_batches(dealt(spark, 40), path, 3, "a")
    assert trainers.read_batches(spark, path).count() == 80


def test_an_empty_table_is_published(spark, tmp_path):
    path = str(tmp_path / "feed")
    trainers.write_batches(dealt(spark, 9).where("position < 0"), path, 3, "a")
    assert trainers.read_batches(spark, path).count() == 0


def test_stretches_of_a_batch():
    import pyarrow as pa

    pick = random.Random(1)
    keys = sorted((pick.randrange(3), pick.randrange(4)) for _ in range(50))
    batch = pa.RecordBatch.from_pydict({"epoch": [k[0] for k in keys], "rank": [k[1] for k in keys], "position": list(range(50))})
    parts = list(trainers._runs(batch))
    assert [p["position"].to_pylist() for p in parts] == [[i for i, k in enumerate(keys) if k == key] for key in sorted(set(keys))]
