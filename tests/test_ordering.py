import datetime as dt
import random
import re
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomframe.operators import ordering
from loomframe.operators.joins import lookup
from loomframe.operators.ordering import Running, row_index, running, trailing


def skewed_rows(n=200, seed=1):
    """One group holds most rows, one group is null."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c", None])
        rows.append((group, i * 3 + rng.randint(0, 2), rng.randint(-5, 9), rng.choice([None, rng.randint(0, 99)])))
    rng.shuffle(rows)
    return rows


def expected(rows, fn):
    out = {}
    for group in {r[0] for r in rows}:
        before = []
        for row in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]):
            out[row[:2]] = fn(before, row)
            before.append(row)
    return out


def test_running_values_match_a_sequential_pass(spark, ranges):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "g string, o long, v long, s long").repartition(5)
    got = running(
        df, ["o"],
        {
            "total": Running("sum", F.col("v")),
            "start": Running("sum", F.col("v"), current=False),
            "low": Running("min", F.col("v"), current=False),
            "set": Running("last", F.col("s")),
        },
        ["g"],
    ).collect()
    want = expected(
        rows,
        lambda before, row: (
            sum(r[2] for r in before) + row[2],
            sum(r[2] for r in before),
            min((r[2] for r in before), default=None),
            next((r[3] for r in [row, *reversed(before)] if r[3] is not None), None),
        ),
    )
    assert len(got) == len(rows)
    assert {(r.g, r.o): (r.total, r.start, r.low, r.set) for r in got} == want


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_row_index_does_not_depend_on_partitions(spark, ranges, partitions):
    rows = [(f"k{i:04d}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * 7)) for i in range(120)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz").repartition(partitions)
    for key in ("k", "t"):
        got = row_index(df, [key], "i").orderBy("k").collect()
        assert [r.i for r in got] == list(range(120))


def test_many_ranges(spark, tiny_ranges):
    df = spark.range(300).select((F.col("id") * 7 % 300).alias("k"))
    got = row_index(df, ["k"], "i").collect()
    assert all(r.i == r.k for r in got) and len(got) == 300


@pytest.mark.parametrize(
    "dtype, value",
    [
        ("decimal(20,4)", "cast(id * 1.0001 - 50 as decimal(20,4))"), ("binary", "unhex(lpad(hex(id), 4, '0'))"),
        ("timestamp", "timestamp_micros(id * 3600000001)"), ("timestamp_ntz", "timestamp_ntz '2024-03-09 00:00:00' + make_interval(0, 0, 0, 0, id)"),
        ("date", "date_add(date '1969-11-01', cast(id as int))"), ("double", "id / 7.0D - 9"), ("string", "concat('é\\'', lpad(cast(id as string), 4, '0'))"),
        ("boolean", "id > 99"), ("smallint", "cast(id - 100 as smallint)"),
    ],
)
def test_keys_of_all_types_under_any_time_zone(spark, tiny_ranges, monkeypatch, dtype, value):
    """The driver's zone must not matter: values never become Python objects."""
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = spark.range(200).select("id", F.expr(value).cast(dtype).alias("k")).repartition(7)
        cuts = ordering._cuts(df, ["k", "id"], 200, 7)
        spread = ordering._with_range(df, ["k", "id"], cuts).groupBy(ordering._RANGE).count().collect()
        got = row_index(df, ["k", "id"], "i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        monkeypatch.undo()
        time.tzset()
    assert [r["id"] for r in sorted(got, key=lambda r: r["i"])] == list(range(200))
    assert len(spread) > 15 and max(r["count"] for r in spread) < 40


def test_one_plan_for_every_size(spark, monkeypatch):
    def operators(rows):
        df = spark.range(rows).withColumn("g", F.col("id") % 3)
        plan = row_index(df, ["id"], "i", ["g"])._jdf.queryExecution().sparkPlan().toString()
        return re.findall(r"^[ :+\-]*(\w+)", plan, re.M)

    assert operators(50) == operators(5_000)
    spark.conf.set(ordering.ROWS_PER_RANGE_CONF, "500")
    try:
        assert operators(5_000) == operators(50)
    finally:
        spark.conf.unset(ordering.ROWS_PER_RANGE_CONF)


def test_ties_in_the_group_and_composite_order(spark, tiny_ranges):
    rows = [(i // 40, i % 40 // 4, i % 4, 0.5 * i) for i in range(160)]
    df = spark.createDataFrame(rows, "g int, a int, b int, v double")
    got = row_index(df, ["a", "b"], "i", ["g"]).orderBy("g", "a", "b").collect()
    assert [r.i for r in got] == list(range(40)) * 4


def test_empty_table(spark, ranges):
    df = spark.createDataFrame([], "g string, o long")
    assert row_index(df, ["o"], "i", ["g"]).collect() == []


def test_trailing_frames_cross_bucket_borders(spark):
    rows = [(g, i, float(i * i % 17)) for g, n in (("hot", 90), ("x", 4)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i long, v double")
    for width in (1, 2, 5):
        got = trailing(df, "i", width, {"m": F.avg("v"), "n": F.count("v")}, ["g"], bucket_rows=8).collect()
        frame = pd.DataFrame(rows, columns=["g", "i", "v"])
        want = frame.groupby("g")["v"].rolling(width, min_periods=1).mean().droplevel(0)
        assert len(got) == len(rows)
        for row in got:
            at = frame.index[(frame.g == row.g) & (frame.i == row.i)][0]
            assert row.m == pytest.approx(want[at])
            assert row.n == min(width, row.i + 1)


def test_trailing_refuses_buckets_below_the_frame(spark):
    with pytest.raises(ValueError):
        trailing(spark.range(3).withColumnRenamed("id", "i"), "i", 5, {"m": F.count("i")}, bucket_rows=4)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_splits_hot_keys_and_keeps_every_row(spark, tiny_ranges, how):
    left = [("hot" if i % 3 else f"k{i % 10}", i) for i in range(150)] + [(None, 900), ("missing", 901)]
    right = [("hot", "H")] + [(f"k{i}", f"K{i}") for i in range(10)]
    a, b = spark.createDataFrame(left, "k string, i long"), spark.createDataFrame(right, "rk string, v string")
    want = sorted(tuple(r) for r in a.join(b, F.col("k") == F.col("rk"), how).select("i", "v").collect())
    assert sorted(tuple(r) for r in lookup(a, b, "k", "rk", how).select("i", "v").collect()) == want


def test_lookup_spreads_equal_rows(spark):
    from loomframe.operators import joins

    same = spark.range(20_000).select(F.lit("hot").alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"), F.lit(20).alias("__salts"))
    sizes = [r["count"] for r in joins._spread(same.repartition(3)).groupBy("__salt").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 1.1 * min(sizes)
    spark.conf.set(ordering.ROWS_PER_RANGE_CONF, "1000")
    try:
        right = spark.createDataFrame([("hot", 1), ("x", 2)], "rk string, v int")
        got = lookup(same.drop("__salts").union(spark.sql("SELECT 'x', map('b', 2)")), right, "k", "rk")
        assert sorted(map(tuple, got.groupBy("v").count().collect())) == [(1, 20_000), (2, 1)] and got.columns == ["k", "m", "rk", "v"]
    finally:
        spark.conf.unset(ordering.ROWS_PER_RANGE_CONF)
