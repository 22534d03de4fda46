import random

import pytest
from pyspark.sql import functions as F

from loomframe.operators import trees
from tests import models

SCHEMA = "ord long, message_id string, parent_id string, role string, text string, lang string"


def forest(spark, rows):
    return spark.createDataFrame([(o, i, p, "prompter", f"text {i}", lang) for o, i, p, lang in rows], SCHEMA)


def all_paths(df, lang="en"):
    rows = trees.collect_paths(trees.tree_path_rows(df, lang)).collect()
    assert all(r.n_turns == len(r.ids) and r.path == r.ids[-1] for r in rows)
    return sorted(r.ids for r in rows)


def test_three_paths_of_one_tree(spark):
    rows = [(0, "q", None, "en"), (1, "a", "q", "en"), (2, "b", "q", "en"), (3, "a1", "a", "en"), (4, "x", "a1", "en"), (5, "y", "a1", "en")]
    assert all_paths(forest(spark, rows)) == [["q", "a", "a1", "x"], ["q", "a", "a1", "y"], ["q", "b"]]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forest_equals_depth_first_walk(spark, ranges, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        parent = None if rng.random() < 0.08 else f"m{rng.randint(0, i - 1)}" if i and rng.random() < 0.8 else ("m0" if i else None)
        rows.append((i, f"m{i}", parent, rng.choice(["en", "en", "de", None]) if parent is None else "en"))
    got = all_paths(forest(spark, rows).repartition(4))
    assert got == sorted(models.paths(rows))


def test_recursive_queries_give_the_same_paths(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        some = rng.choice([f"m{rng.randint(0, max(i - 1, 0))}"] * 9 + [f"m{i - 1}"] * 9 + ["nowhere"])
        parent = None if i < 6 or rng.random() < 0.1 else some
        rows.append((i, f"m{i}", parent, rng.choice(["en", "de", None]) if parent is None else "en"))
    rows += [(200, "c1", "c2", "en"), (201, "c2", "c1", "en")]
    df = forest(spark, rows).repartition(3)
    for lang, turns in ((None, 2), ("en", 2), ("en", 4)):
        want = sorted(map(tuple, trees.tree_path_rows(df, lang, turns).collect()))
        assert want and sorted(map(tuple, trees.recursive_path_rows(df, lang, turns).collect())) == want
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    for limits in ({"most_levels": 2}, {"most_rows": 20}):
        with pytest.raises(Exception, match="RECURSION_.*LIMIT"):
            trees.recursive_path_rows(df, **limits)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_odd_input(spark):
    rows = [
        (0, "alone", None, "en"),
        (1, "root", None, "en"), (2, "leaf", "root", "de"),
        (3, "lost", "nowhere", "en"), (4, "lost2", "lost", "en"),
        (5, "c1", "c3", "en"), (6, "c2", "c1", "en"), (7, "c3", "c2", "en"), (8, "under", "c2", "en"),
        (9, "null", None, None), (10, "nl", "null", "en"),
        (11, "german", None, "de"), (12, "gl", "german", "de"),
    ]
    df = forest(spark, rows)
    assert all_paths(df) == [["root", "leaf"]]
    assert len(all_paths(df, lang=None)) == 3
    assert len(all_paths(df.drop("lang"))) == 3
    hanging = {r.message_id for r in trees.unreachable(df).collect()}
    assert hanging == {"lost", "lost2", "c1", "c2", "c3", "under"}


def test_deep_chain(spark, ranges):
    rows = [(i, f"m{i:03d}", None if i == 0 else f"m{i - 1:03d}", "en") for i in range(75)]
    assert all_paths(forest(spark, rows)) == [[f"m{i:03d}" for i in range(75)]]


def test_wide_tree(spark, tiny_ranges):
    rows = [(0, "r", None, "en")] + [(i, f"k{i}", "r", "en") for i in range(1, 60)]
    assert all_paths(forest(spark, rows)) == sorted([["r", f"k{i}"] for i in range(1, 60)])
    children = trees.parent_child(forest(spark, rows))
    assert children.count() == 59


def test_first_child_paths(spark):
    rows = [(0, "q", None, "en"), (5, "late", "q", "en"), (2, "early", "q", "en"), (9, "e2", "early", "en"), (1, "alone", None, "en")]
    got = trees.collect_paths(trees.first_child_path_rows(forest(spark, rows))).collect()
    assert [(r.path, r.ids) for r in got] == [("q", ["q", "early", "e2"])]
    assert trees.first_child_path_rows(forest(spark, rows), min_turns=4).count() == 0
    assert {r.path for r in trees.first_child_path_rows(forest(spark, rows), min_turns=1).collect()} == {"q", "alone"}


def test_dedup_keeps_the_last(spark):
    rows = [(0, "r", None, "en"), (1, "a", "r", "en"), (2, "b", "r", "en"), (3, "a", "b", "en")]
    kept = trees.dedup_last(forest(spark, rows))
    assert all_paths(kept) == [["r", "b", "a"]]


def test_path_turns_carry_texts(spark):
    df = forest(spark, [(0, "r", None, "en"), (1, "a", "r", "en")])
    got = trees.path_turns(trees.tree_path_rows(df), df).orderBy("pos").collect()
    assert [(r.pos, r.text) for r in got] == [(0, "text r"), (1, "text a")]


def test_leaves(spark):
    df = forest(spark, [(0, "r", None, "en"), (1, "a", "r", "en"), (2, "b", "a", "en"), (3, "c", "r", "en")])
    assert {r.message_id for r in trees.leaves(df).select(F.col("message_id")).collect()} == {"b", "c"}


def test_paths_are_numbered_depth_first(spark):
    rows = [(o, f"m{o}", None if p is None else f"m{p}") for o, p in [(5, None), (9, 5), (7, 5), (8, 7), (-3, 7), (1, None), (2, 1)]]
    forest = spark.createDataFrame(rows, "ord long, message_id string, parent_id string")
    paths = trees.collect_paths(trees.tree_path_rows(forest), forest).orderBy("path_ord").collect()
    assert [(r.path_ord, r.ids) for r in paths] == [(0, ["m1", "m2"]), (1, ["m5", "m7", "m-3"]), (2, ["m5", "m7", "m8"]), (3, ["m5", "m9"])]


def test_circles_end_the_climb(spark):
    rows = [(i, i, (i + 1) % 600) for i in range(600)] + [(1000, 1000, None), (1001, 1001, 1000), (1002, 1002, 77777)]
    forest = spark.createDataFrame(rows, "ord long, message_id long, parent_id long")
    assert sorted(r.id for r in trees.rooted(forest).collect()) == [1000, 1001]
    assert trees.unreachable(forest).count() == 601
