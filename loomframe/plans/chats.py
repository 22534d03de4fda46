"""Conversation queries: trees, template, examples, context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.functions.text import strip
from loomframe.operators import bpe, chat, scored, trees
from loomframe.operators.tokens import BYTES, decode_bytes
from loomframe.plans.registry import query
from loomframe.plans.tables import (
    BLOCK, INSTRUCTIONS_SQL, MESSAGES_SQL, SQL_SPACE, TURNS_SQL, instructions, load, messages, turns,
)
from loomframe.plans.text import SAMPLE_MERGES, merged_sql, total, weighted_total
from loomframe.session import work_path
from loomframe.sources import corpus

_USER, _ASSISTANT, _END = chat.USER_MARK, chat.ASSISTANT_MARK, chat.END_MARK
_RENDERED = f"""CASE WHEN role = 'prompter' THEN '{_USER}' || chr(10) || text || chr(10)
     ELSE '{_ASSISTANT}' || chr(10) || text || chr(10) || '{_END}' END"""


def digest(column: str):
    return F.md5(F.col(column).cast("binary")).alias("digest")


@query("scan_messages", f"WITH {MESSAGES_SQL} SELECT message_id, parent_id, role, lang, md5(text) AS digest FROM messages")
def scan_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest written by language and read back."""
    path = work_path(spark, "messages")
    messages(spark, sf_dir).withColumn("split", F.col("lang")).write.partitionBy("split").parquet(path)
    german, english = (corpus.read_messages(spark, path, split) for split in ("de", "en"))
    return german.unionByName(english).select("message_id", "parent_id", "role", "lang", digest("text"))


@query("scan_instructions", f"""
WITH {INSTRUCTIONS_SQL} SELECT pair_id, md5(instruction) AS instruction, md5(input) AS input, md5(output) AS output FROM instructions""")
def scan_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "instructions")
    instructions(spark, sf_dir).write.parquet(path)
    return corpus.read_instructions(spark, path).select(
        "pair_id", *[F.md5(F.col(c).cast("binary")).alias(c) for c in ("instruction", "input", "output")]
    )


@query("min_turns", "SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id HAVING count(*) >= 4")
def min_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = load(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    return sizes.where(F.col("n_turns") >= 4)


@query("instruction_chat", f"""
WITH {INSTRUCTIONS_SQL},
kept AS (SELECT * FROM instructions WHERE regexp_matches(output, '[^{SQL_SPACE}]'))
SELECT pair_id, 0::BIGINT AS pos, 'prompter' AS role,
       md5(CASE WHEN regexp_matches(coalesce(input, ''), '[^{SQL_SPACE}]')
           THEN instruction || chr(10) || chr(10) || 'Input: ' || input ELSE instruction END) AS digest FROM kept
UNION ALL SELECT pair_id, 1::BIGINT, 'assistant', md5(output) FROM kept""")
def instruction_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.instruction_turns(instructions(spark, sf_dir), "pair_id").select("pair_id", "pos", "role", digest("text"))


_SEGMENTS = f"""segs AS (
  SELECT conv_id, turn, unnest(CASE WHEN role = 'prompter'
    THEN [{{'text': '{_USER}', 'mask': 0, 'seg': 0}}, {{'text': chr(10) || text || chr(10), 'mask': 0, 'seg': 1}}]
    ELSE [{{'text': '{_ASSISTANT}', 'mask': 0, 'seg': 0}}, {{'text': chr(10), 'mask': 0, 'seg': 1}}, {{'text': text, 'mask': 1, 'seg': 2}},
          {{'text': chr(10), 'mask': 1, 'seg': 3}}, {{'text': '{_END}', 'mask': 1, 'seg': 4}}] END) AS s FROM turns)"""


@query("chat_render", f"""
WITH {TURNS_SQL}, {_SEGMENTS}
SELECT conv_id, turn, s.seg::BIGINT AS seg, s.mask::INTEGER AS mask, md5(s.text) AS digest FROM segs""")
def chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as its segments; a conversation is its turns in order and is never one row."""
    cut = turns(spark, sf_dir).select(
        "conv_id", "turn", F.posexplode(chat.segments(F.col("role"), F.col("text"))).alias("seg", "s")
    )
    return cut.select("conv_id", "turn", F.col("seg").cast("long").alias("seg"), "s.mask", F.col("s.text").alias("text")).select(
        "conv_id", "turn", "seg", "mask", digest("text")
    )


@query("chat_text", f"WITH {TURNS_SQL} SELECT conv_id, turn, md5({_RENDERED}) AS digest FROM turns")
def chat_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = turns(spark, sf_dir).withColumn("said", chat.rendered(F.col("role"), F.col("text")))
    return said.select("conv_id", "turn", digest("said"))


@query("role_mask", f"""
WITH {TURNS_SQL} SELECT conv_id, turn, role, CASE WHEN role = 'prompter' THEN 0 ELSE 1 END AS trained,
  CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS assistant_only FROM turns""")
def role_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).select(
        "conv_id", "turn", "role", chat.is_trained(F.col("role")).alias("trained"),
        chat.is_trained(F.col("role"), ("assistant",)).alias("assistant_only"),
    )


# One row per turn with its place in the conversation's token stream
_PLACED = TURNS_SQL + f""", said AS (
  SELECT conv_id, turn, role, encode({_RENDERED}) AS raw, octet_length(encode({_RENDERED})) AS n FROM turns),
placed AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) - n AS start,
         CASE WHEN role = 'prompter' THEN n ELSE {len(_ASSISTANT) + 1} END AS lead FROM said)"""


def example_sums(end: int) -> str:
    """Sums that pin down inputs and labels, from a CTE ``toks`` (conv_id, pos, tok, trained) of the first tokens."""
    return f"""sums AS (
  SELECT conv_id, count(*) AS len,
    sum(CASE WHEN pos < {BLOCK} THEN tok ELSE 0 END) AS xs, sum(CASE WHEN pos < {BLOCK} THEN tok * pos ELSE 0 END) AS xd,
    sum(CASE WHEN trained AND pos > 0 THEN 1 ELSE 0 END) AS ln, sum(CASE WHEN trained AND pos > 0 THEN tok ELSE 0 END) AS ls,
    sum(CASE WHEN trained AND pos > 0 THEN tok * (pos - 1) ELSE 0 END) AS ld FROM toks GROUP BY conv_id)
SELECT conv_id, {BLOCK}::BIGINT AS n_inputs,
  (xs + {end} * greatest({BLOCK} - len, 0))::BIGINT AS input_sum,
  (xd + CASE WHEN len < {BLOCK} THEN {end} * (({BLOCK} - 1) * {BLOCK} / 2 - (len - 1) * len / 2) ELSE 0 END)::BIGINT AS input_dot,
  ln::BIGINT AS n_labels, ls::BIGINT AS label_sum, ld::BIGINT AS label_dot FROM sums"""


@query("sft_examples", f"""
WITH {_PLACED}, toks AS (
  SELECT conv_id, start + i AS pos, tok, i >= lead AS trained FROM (
    SELECT conv_id, start, lead, unnest(range(n)) AS i,
           unnest(list_transform(regexp_extract_all(hex(raw), '..'), lambda h: ('0x' || h)::INTEGER)) AS tok FROM placed)
  WHERE start + i <= {BLOCK}),
{example_sums(256)}""")
def sft_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples_of(spark, sf_dir, BYTES)


def examples_of(spark: SparkSession, sf_dir: str, carrier) -> DataFrame:
    chats = turns(spark, sf_dir)
    examples = chat.sft_examples(chats, carrier, BLOCK, "conv_id", "turn", rows=chats.count())
    labels = F.transform("labels", lambda v: F.when(v == chat.IGNORED, 0).otherwise(v))
    return examples.select(
        "conv_id", F.size("input_ids").cast("long").alias("n_inputs"), total(F.col("input_ids")).alias("input_sum"),
        weighted_total(F.col("input_ids")).alias("input_dot"),
        F.size(F.filter("labels", lambda v: v != chat.IGNORED)).cast("long").alias("n_labels"),
        total(labels).alias("label_sum"), weighted_total(labels).alias("label_dot"),
    )


@query("sft_merged", f"""
WITH {TURNS_SQL}, {_SEGMENTS},
texts AS (SELECT conv_id, turn, s.seg AS seg, s.mask AS mask, s.text AS text FROM segs),
{merged_sql("texts", "conv_id, turn, seg, mask")},
toks AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, seg, piece, place) - 1 AS pos, tok, mask = 1 AS trained
  FROM merged QUALIFY pos <= {BLOCK}),
{example_sums(256 + len(SAMPLE_MERGES))}""")
def sft_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat examples in byte-pair tokens, each segment encoded on its own."""
    return examples_of(spark, sf_dir, bpe.carrier(spark, bpe.Vocabulary.from_merges(SAMPLE_MERGES)))


@query("label_coverage", f"""
WITH {_PLACED}, firsts AS (SELECT DISTINCT conv_id FROM placed),
kept AS (SELECT greatest(least(start + n, {BLOCK + 1}) - greatest(start + lead, 1), 0) AS labels FROM placed JOIN firsts USING (conv_id))
SELECT sum(labels)::BIGINT AS labels, ((SELECT count(*) FROM firsts) * {BLOCK})::BIGINT AS positions,
       round(sum(labels) * 100.0 / ((SELECT count(*) FROM firsts) * {BLOCK}), 6)::DOUBLE AS coverage FROM kept""")
def label_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = turns(spark, sf_dir)
    covered = scored.label_coverage(chat.sft_examples(chats, BYTES, BLOCK, "conv_id", "turn", rows=chats.count()), "conv_id")
    return covered.withColumn("coverage", F.round("coverage", 6))


@query("parent_child", f"""
WITH {MESSAGES_SQL} SELECT c.message_id, c.parent_id, c.role, p.role AS parent_role
FROM messages c JOIN messages p ON c.parent_id = p.message_id""")
def parent_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").count()
    return trees.parent_child(messages(spark, sf_dir), rows).select("message_id", "parent_id", "role", "parent_role")


@query("tree_leaves", f"""
WITH {MESSAGES_SQL} SELECT message_id FROM messages m
WHERE NOT EXISTS (SELECT 1 FROM messages c WHERE c.parent_id = m.message_id)""")
def tree_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.leaves(messages(spark, sf_dir)).select("message_id")


@query("dedup_last", """
SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.dedup_last(load(spark, sf_dir, "events"), "user_id", "event_id").select("user_id", "event_id", "value")


def walk_sql(replies: str, roots: str = "") -> str:
    return f"""WITH RECURSIVE {MESSAGES_SQL}, walk AS (
  SELECT message_id AS root_id, message_id AS id, 1::BIGINT AS n_turns, message_id::VARCHAR AS path FROM messages
  WHERE parent_id IS NULL {roots}
  UNION ALL SELECT w.root_id, m.message_id, w.n_turns + 1, w.path || ',' || m.message_id FROM walk w JOIN {replies} m ON m.parent_id = w.id)
"""


@query("tree_paths", walk_sql("messages", "AND lang = 'en'") + """
SELECT id AS leaf_id, n_turns, path, row_number() OVER (ORDER BY string_split(path, ',')::BIGINT[]) - 1 AS path_ord FROM walk w
WHERE n_turns >= 2 AND NOT EXISTS (SELECT 1 FROM messages c WHERE c.parent_id = w.id)""")
def tree_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = trees.dedup_last(messages(spark, sf_dir))
    return trees.collect_paths(trees.tree_path_rows(forest, lang="en"), forest).select(
        F.col("path").alias("leaf_id"), "n_turns", "path_ord", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("path")
    )


_FIRST = "(SELECT * FROM messages QUALIFY row_number() OVER (PARTITION BY parent_id ORDER BY ord) = 1)"


@query("first_child_paths", walk_sql(_FIRST) + """
SELECT root_id, n_turns, path FROM walk w
WHERE n_turns >= 2 AND NOT EXISTS (SELECT 1 FROM messages c WHERE c.parent_id = w.id)""")
def first_child_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trees.first_child_path_rows(trees.dedup_last(messages(spark, sf_dir)))
    return trees.collect_paths(rows).select(
        F.col("path").alias("root_id"), "n_turns", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("path")
    )


@query("tree_turns", walk_sql("messages", "AND lang = 'en'") + """,
ends AS (SELECT id AS leaf_id, path FROM walk w
  WHERE n_turns >= 2 AND NOT EXISTS (SELECT 1 FROM messages c WHERE c.parent_id = w.id)),
steps AS (SELECT leaf_id, unnest(string_split(path, ','))::BIGINT AS id, unnest(range(len(string_split(path, ',')))) AS pos FROM ends)
SELECT s.leaf_id, s.pos, m.role, md5(m.text) AS digest FROM steps s JOIN messages m ON m.message_id = s.id""")
def tree_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paths as chat turns, one message per row."""
    forest = trees.dedup_last(messages(spark, sf_dir))
    said = trees.path_turns(trees.tree_path_rows(forest, lang="en"), forest)
    return said.select(F.col("path").alias("leaf_id"), "pos", "role", digest("text"))


@query("unreachable_messages", f"""
WITH RECURSIVE {MESSAGES_SQL}, kept AS (SELECT * FROM messages WHERE parent_id IS NOT NULL OR message_id % 2 = 0),
walk AS (SELECT message_id AS id FROM kept WHERE parent_id IS NULL
  UNION ALL SELECT m.message_id FROM walk w JOIN kept m ON m.parent_id = w.id)
SELECT message_id FROM kept WHERE message_id NOT IN (SELECT id FROM walk)""".replace("message_id % 2", "(message_id // 1000) % 2"))
def unreachable_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies left hanging when every other root is taken away."""
    forest = messages(spark, sf_dir)
    even = F.call_function("div", F.col("message_id"), F.lit(1000).cast("long")) % 2 == 0
    return trees.unreachable(forest.where(F.col("parent_id").isNotNull() | even)).select("message_id")


_CONTEXT = 724


@query("chat_context", f"""
WITH {TURNS_SQL}, gaps AS (SELECT conv_id, turn, role, CASE WHEN (conv_id + turn) % 11 = 0 THEN '' ELSE text END AS text FROM turns),
said AS (
  SELECT conv_id, turn, role, CASE WHEN role = 'prompter' THEN '{_USER}' || chr(10) || text || chr(10) || '{_ASSISTANT}' || chr(10)
    ELSE text || chr(10) || '{_END}' END AS s FROM gaps),
seen AS (SELECT conv_id, turn, role, right(string_agg(hex(encode(s)), '') OVER (PARTITION BY conv_id ORDER BY turn), {2 * _CONTEXT}) AS h FROM said)
SELECT conv_id, turn, (length(h) // 2)::BIGINT AS n_tokens, md5(h) AS digest FROM seen WHERE role = 'prompter'""")
def chat_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns, system turns included; every eleventh text is missing."""
    chats = turns(spark, sf_dir)
    spoken = chats.withColumn("text", F.when((F.col("conv_id") + F.col("turn")) % 11 != 0, F.col("text")))
    seen = chat.chat_context(spoken, BYTES, _CONTEXT, "conv_id", "turn", rows=chats.count())
    hexed = F.array_join(F.transform("context", lambda t: F.lpad(F.hex(t), 2, "0")), "")
    return seen.select("conv_id", "turn", F.size("context").cast("long").alias("n_tokens"), F.md5(hexed.cast("binary")).alias("digest"))


@query("reset_sessions", """
WITH flagged AS (
  SELECT event_id, user_id, ts, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS is_reset,
         CASE WHEN event_type = 'error' THEN value END AS setting FROM events)
SELECT event_id, user_id, (sum(is_reset) OVER w)::BIGINT AS session_id, last_value(setting IGNORE NULLS) OVER w AS setting
FROM flagged WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def reset_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    setting = F.when(F.col("event_type") == "error", F.col("value"))
    sessions = chat.reset_sessions(
        events, ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", {"setting": setting}, rows=events.count()
    )
    return sessions.select("event_id", "user_id", "session_id", "setting")


@query("trim_at_stop", f"""
SELECT conv_id, turn, md5(regexp_replace(regexp_replace(cut, '^[{SQL_SPACE}]+', ''), '[{SQL_SPACE}]+$', '')) AS digest FROM (
  SELECT conv_id, turn, CASE WHEN strpos(text, '. ') > 0 THEN left(text, strpos(text, '. ') - 1) ELSE text END AS cut FROM conversations)""")
def trim_at_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte tokens of each turn up to the first full stop and space, read back and stripped."""
    chats = load(spark, sf_dir, "conversations")
    said = chats.select("conv_id", "turn", BYTES.ids(BYTES.from_text(F.col("text"))).alias("tokens"))
    cut = scored.trim_at_stop(said, "tokens", [ord("."), ord(" ")], BYTES.end)
    return cut.withColumn("kept", strip(decode_bytes(F.col("tokens")))).select("conv_id", "turn", digest("kept"))


@query("keep_last", """
SELECT conv_id, turn, md5(right(hex(encode(text)), 100)) AS digest FROM conversations""")
def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 50 byte tokens of each turn."""
    said = load(spark, sf_dir, "conversations").select("conv_id", "turn", BYTES.ids(BYTES.from_text(F.col("text"))).alias("tokens"))
    hexed = F.array_join(F.transform(scored.keep_last(F.col("tokens"), 50), lambda t: F.lpad(F.hex(t), 2, "0")), "")
    return said.select("conv_id", "turn", F.md5(hexed.cast("binary")).alias("digest"))
