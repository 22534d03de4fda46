"""The plans Spark makes of the operators."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomframe.operators import runs, scored, trees
from loomframe.operators.ordering import row_index

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_limits_reach_the_map_side(spark):
    log = spark.range(10**6).select((F.col("id") % 2).cast("string").alias("run"), F.col("id").alias("step"), F.col("id").cast("double").alias("loss"))
    assert plan_of(runs.head_tail(log)).count("WindowGroupLimit") >= 4  # partial and final, at both ends
    logits = log.select(F.col("step").alias("ctx_id"), F.col("step").alias("token_id"), F.col("loss").alias("logit"))
    assert "WindowGroupLimit" in plan_of(scored.topk_ties(logits, 3))
    messages = log.select(F.col("run").alias("message_id"), F.col("step").alias("ord"))
    assert "WindowGroupLimit" in plan_of(trees.dedup_last(messages))


def test_ranges_replace_the_single_partition_window(spark, tiny_ranges):
    plan = plan_of(row_index(spark.range(100), ["id"], "i"))
    assert "SinglePartition" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name", ["pack_blocks", "tree_turns", "chat_context", "nucleus", "curve_downsample", "sft_examples"])
def test_no_products(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["smooth_metric", "running_best", "topk_ties", "weighted_draw", "pretokenize", "holdout_split", "tree_leaves"])
def test_no_python_where_sql_functions_do(spark, name):
    assert "Python" not in plan_of(entry.queries()[name](spark, SF_DIR))


def test_texts_are_read_once_and_prefixes_stop_the_scan(spark):
    plan = plan_of(entry.queries()["pack_blocks"](spark, SF_DIR))
    assert plan.count("ReadSchema: struct<doc_id:bigint,text:string>") == 1  # lengths come from a written table
    plan = plan_of(entry.queries()["prefix_eval"](spark, SF_DIR))
    assert "LessThanOrEqual(doc_id," in plan


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(entry.queries()["holdout_split"](spark, SF_DIR))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    plan = plan_of(entry.queries()["min_turns"](spark, SF_DIR))
    assert "ReadSchema: struct<conv_id:bigint>" in plan
