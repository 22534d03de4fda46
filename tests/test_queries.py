"""Every registered query against its SQL, with the small tables cut into many ranges."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare, rows_of
from loomframe.operators.ordering import ROWS_PER_RANGE_CONF
from loomframe.plans import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()[0]))
def test_query(spark, db, name):
    spark.conf.set(ROWS_PER_RANGE_CONF, "40")
    try:
        df = entry.queries()[name](spark, SF_DIR)
        got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.unset(ROWS_PER_RANGE_CONF)
    if name not in entry.oracle_sql():
        assert got
        return
    result = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert compare(got, rows_of(names, result.fetchall())) == "ok"


def same_as_sql(spark, name, events, tmp_path):
    """A query over the given events (rows in SQL) against its own SQL."""
    connection = duckdb.connect()
    connection.execute(f"COPY ({events}) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    df = entry.queries()[name](spark, str(tmp_path))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(entry.oracle_sql()[name])
    return compare(got, rows_of([c[0] for c in result.description], result.fetchall()))


def test_metrics_scan_keeps_every_microsecond_of_a_long_log(spark, tmp_path):
    events = f"""SELECT event_id + 1000 * k AS event_id, ts + to_days(400 * k::INTEGER) AS ts, user_id, event_type, value, props
    FROM '{SF_DIR}/events.parquet', range(4) t(k)"""
    assert same_as_sql(spark, "metrics_scan", events, tmp_path) == "ok"


def test_stream_metrics_has_one_order_for_rows_of_one_step(spark, tmp_path):
    events = """SELECT i // 700 AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i // 700 * 3) AS ts, 1::BIGINT AS user_id, 'a' AS event_type,
    1 + i // 700 * 7919 % 1000 / 10 AS value, NULL::VARCHAR AS props FROM range(100000) t(i)"""
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # frames of one step then end up in several tasks
    try:
        assert same_as_sql(spark, "stream_metrics", events, tmp_path) == "ok"
    finally:
        spark.conf.set(coalesce, "true")
