"""Message forests: reply links to conversation paths.

Ids, never texts, travel through the loops. Every loop doubles its reach per round, so a tree of
depth d takes about log2(d) rounds of equi-joins, and rows stay narrow however deep the tree is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.operators.joins import lookup
from loomframe.operators.ordering import row_index
from loomframe.session import cut_lineage


def dedup_last(messages: DataFrame, key: str = "message_id", order: str = "ord") -> DataFrame:
    """Keep the last row of every id."""
    latest = Window.partitionBy(key).orderBy(F.col(order).desc())
    return messages.withColumn("__rn", F.row_number().over(latest)).where(F.col("__rn") == 1).drop("__rn")


def parent_child(messages: DataFrame, rows: int | None = None) -> DataFrame:
    """Each message that has a known parent, next to that parent's role."""
    parents = messages.select(F.col("message_id").alias("__parent"), F.col("role").alias("parent_role"))
    children = messages.where(F.col("parent_id").isNotNull())
    return lookup(children, parents, "parent_id", "__parent", rows=rows).drop("__parent")


def leaves(messages: DataFrame) -> DataFrame:
    """Messages nobody replies to."""
    replied = messages.select(F.col("parent_id").alias("__replied")).where(F.col("__replied").isNotNull()).distinct()
    return messages.join(replied, F.col("message_id") == F.col("__replied"), "left_anti")


def _wanted_root(messages: DataFrame, lang: str | None) -> Column:
    # an absent language column keeps every tree, a null language keeps none
    if lang is None or "lang" not in messages.columns:
        return F.lit(True)
    return F.coalesce(F.col("lang") == lang, F.lit(False))


def rooted(messages: DataFrame, lang: str | None = None) -> DataFrame:
    """``id, parent, depth, wanted`` of every message that hangs under a root.

    Messages whose chain of parents ends in an unknown id or runs in a circle are left out.
    """
    start = messages.select(
        F.col("message_id").alias("id"),
        F.col("parent_id").alias("parent"),
        F.coalesce("parent_id", "message_id").alias("up"),
        F.when(F.col("parent_id").isNull(), 0).otherwise(1).cast("long").alias("depth"),
        F.col("parent_id").isNull().alias("done"),
        F.when(F.col("parent_id").isNull(), _wanted_root(messages, lang)).alias("wanted"),
    )
    start = cut_lineage(start)
    total = start.count()
    finished, open_rows = [start.where("done")], start.where(~F.col("done"))
    while not open_rows.isEmpty():
        above = reduce(DataFrame.unionByName, [*finished, open_rows]).select(
            F.col("id").alias("a_id"), F.col("up").alias("a_up"), F.col("depth").alias("a_depth"),
            F.col("done").alias("a_done"), F.col("wanted").alias("a_wanted"),
        )
        climbed = cut_lineage(
            lookup(open_rows, above, "up", "a_id", rows=total).select(
                "id", "parent", F.col("a_up").alias("up"), (F.col("depth") + F.col("a_depth")).alias("depth"),
                F.col("a_done").alias("done"), F.col("a_wanted").alias("wanted"),
            )
        )
        arrived = climbed.where("done")
        if arrived.isEmpty():  # depths have no gaps, so what is left runs in circles
            break
        finished.append(arrived)
        open_rows = climbed.where(~F.col("done"))
    return reduce(DataFrame.unionByName, finished).select("id", "parent", "depth", "wanted")


def unreachable(messages: DataFrame) -> DataFrame:
    """Messages that hang under no root: their parent is unknown or their replies run in a circle."""
    return messages.join(rooted(messages).select(F.col("id").alias("message_id")), "message_id", "left_anti")


def _follow(starts: DataFrame, hops: DataFrame) -> DataFrame:
    """``path, step, id`` for every node met by following ``src -> dst`` from each start.

    Every node has at most one hop and the chains end. Round r extends all chains from 2**r to
    2**(r+1) nodes through a table of jumps of that length.
    """
    jump = hops.select("src", "dst")
    jumps, met = jump.count(), starts.count()
    found = [starts.select("path", F.lit(0).cast("long").alias("step"), "id")]
    reach = 1
    while True:
        so_far = reduce(DataFrame.unionByName, found)
        ahead = cut_lineage(
            lookup(so_far, jump, "id", "src", rows=met).select(
                "path", (F.col("step") + reach).alias("step"), F.col("dst").alias("id")
            )
        )
        added = ahead.count()
        if added == 0:
            return so_far
        found.append(ahead)
        met += added
        onward = jump.select(F.col("src").alias("src2"), F.col("dst").alias("dst2"))
        jump = cut_lineage(
            lookup(jump, onward, "dst", "src2", rows=jumps).select("src", F.col("dst2").alias("dst"))
        )
        reach *= 2


def tree_path_rows(messages: DataFrame, lang: str | None = None, min_turns: int = 2) -> DataFrame:
    """Every root-to-leaf path in long form: ``path`` (the leaf's id), ``pos`` from the root, ``id``.

    The long form keeps one message per row, so an endless thread stays spread over many tasks.
    """
    nodes = cut_lineage(rooted(messages, lang).where("wanted"))
    replied = nodes.select(F.col("parent").alias("__replied")).where(F.col("__replied").isNotNull()).distinct()
    ends = (
        nodes.join(replied, F.col("id") == F.col("__replied"), "left_anti")
        .where(F.col("depth") + 1 >= min_turns)
        .select(F.col("id").alias("path"), "id", F.col("depth").alias("leaf_depth"))
    )
    ends = cut_lineage(ends)
    hops = nodes.where(F.col("parent").isNotNull()).select(F.col("id").alias("src"), F.col("parent").alias("dst"))
    chains = _follow(ends, hops)
    depth = nodes.select(F.col("id").alias("__n"), F.col("depth").alias("pos"))
    return lookup(chains, depth, "id", "__n").select("path", "pos", "id")


def recursive_path_rows(
    messages: DataFrame, lang: str | None = None, min_turns: int = 2, most_levels: int = 10_000, most_rows: int = 1_000_000_000,
) -> DataFrame:
    """What :func:`tree_path_rows` gives, by Spark's recursive queries: one level of replies a round.

    For flat forests, which take few rounds and no jump tables; it is the caller's choice, and each
    row carries the ids from its root. A reply chain of more than ``most_levels`` or a walk of more than ``most_rows``
    rows is an error and never a shorter result.
    """
    spark = messages.sparkSession
    nodes = cut_lineage(messages.select("message_id", "parent_id", _wanted_root(messages, lang).alias("wanted")))
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(most_rows))
    try:
        walked = cut_lineage(spark.sql(f"""
            WITH RECURSIVE walk(id, ids) MAX RECURSION LEVEL {most_levels} AS (
              SELECT message_id, array(message_id) FROM {{nodes}} WHERE parent_id IS NULL AND wanted
              UNION ALL
              SELECT n.message_id, array_append(w.ids, n.message_id) FROM walk w JOIN {{nodes}} n ON n.parent_id = w.id)
            SELECT id, ids FROM walk""", nodes=nodes))
    finally:
        spark.conf.set(limit, before)
    replied = nodes.select(F.col("parent_id").alias("__replied")).where(F.col("__replied").isNotNull()).distinct()
    ends = walked.join(replied, F.col("id") == F.col("__replied"), "left_anti").where(F.size("ids") >= min_turns)
    return ends.select(F.col("id").alias("path"), F.posexplode("ids").alias("pos", "id")).withColumn("pos", F.col("pos").cast("long"))


def first_child_path_rows(messages: DataFrame, min_turns: int = 2) -> DataFrame:
    """One path per root, always through the earliest reply: ``path`` (the root's id), ``pos``, ``id``."""
    hops = (
        messages.where(F.col("parent_id").isNotNull())
        .groupBy(F.col("parent_id").alias("src"))
        .agg(F.min_by("message_id", "ord").alias("dst"))
    )
    hops = cut_lineage(hops)
    roots = messages.where(F.col("parent_id").isNull())
    if min_turns > 1:  # a root with no reply makes a path of one
        roots = roots.join(hops, F.col("message_id") == F.col("src"), "left_semi")
    roots = roots.select(F.col("message_id").alias("path"), F.col("message_id").alias("id"))
    rows = _follow(cut_lineage(roots), hops).withColumnRenamed("step", "pos")
    if min_turns <= 2:
        return rows
    long_enough = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_turns)
    return rows.join(long_enough.select("path"), "path", "left_semi")


def collect_paths(rows: DataFrame, messages: DataFrame | None = None) -> DataFrame:
    """One row per path with its ids in order. The array is the path itself and no larger.

    With ``messages`` also ``path_ord``, the place of the path in a depth-first walk: paths in the
    order of their messages' ``ord``, compared from the root on.
    """
    if messages is not None:
        ords = messages.select(F.col("message_id").alias("__m"), F.col("ord").cast("long").alias("ord"))
        rows = lookup(rows, ords, "id", "__m").drop("__m")
    ordered = F.array_sort(F.collect_list(F.struct(*["pos", "id", *(["ord"] if messages is not None else [])])))
    paths = rows.groupBy("path").agg(ordered.alias("__steps")).select(
        "path", F.transform("__steps", lambda e: e["id"]).alias("ids"), F.size("__steps").cast("long").alias("n_turns"), "__steps"
    )
    if messages is None:
        return paths.drop("__steps")
    # as text of equal width: flipping the sign bit puts negative numbers first
    spelled = F.transform("__steps", lambda e: F.lpad(F.hex(e["ord"].bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))
    keyed = cut_lineage(paths.select("*", F.array_join(spelled, "").alias("__walk")).drop("__steps"))
    return row_index(keyed, ["__walk", "path"], "path_ord").drop("__walk")


def path_turns(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """Path rows with the role and text of their messages, ready for the chat template."""
    body = messages.select(F.col("message_id").alias("__m"), "role", "text")
    return lookup(rows, body, "id", "__m").select("path", "pos", "role", "text")
