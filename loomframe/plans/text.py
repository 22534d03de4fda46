"""Corpus queries: scans, text functions, encoding and packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.functions.text import drop_blank, preview, strip
from loomframe.operators import batching, bpe, packing
from loomframe.operators.tokens import BYTES, ArrayCarrier, decode_bytes, encode_bytes
from loomframe.plans.registry import query
from loomframe.plans.tables import BLOCK, SQL_SPACE, TOKENS_SQL, load
from loomframe.session import cut_lineage
from loomframe.sources import artifacts, corpus, logs

# Merged tokens of the sample vocabulary: frequent pairs of the test corpus
SAMPLE_MERGES = [
    b"th", b"er", b"in", b"on", b"an", b"re", b"nd", b"es", b"en", b"ed", b"ou", b"ea", b" t", b" a", b" o",
    b"ti", b"the", b"and", b"ing", b" th", b" the", b" an", b" and", b" of", b" in", b"tion", "é".encode(),
]


def documents(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return corpus.read_corpus(spark, f"{sf_dir}/documents.parquet", keep=keep)


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-blank documents, for queries that work hard on every text."""
    return corpus.spread(drop_blank(documents(spark, sf_dir), "text"), "doc_id")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, t: a + t)


def weighted_total(values: Column) -> Column:
    return total(F.transform(values, lambda t, i: t.cast("long") * i))


def block_digest(blocks: DataFrame) -> DataFrame:
    """Integers that pin down ``x`` and ``y``."""
    return blocks.select(
        "block_id", F.get("x", F.lit(0)).alias("x_first"), F.element_at("y", -1).alias("y_last"),
        total(F.col("x")).alias("x_sum"), weighted_total(F.col("y")).alias("y_dot"),
    )


def packed(spark: SparkSession, sf_dir: str, block: int = BLOCK, max_tokens: int | None = None) -> DataFrame:
    rows = documents(spark, sf_dir).count()
    return packing.pack_text(spread_documents(spark, sf_dir), "doc_id", "text", BYTES, block, max_tokens, rows=rows)


def blocks_sql(tokens: str, block: int, limit: str = "") -> str:
    """Digest of the blocks of a token table: a token at a border ends one block and opens the next."""
    return f"""
SELECT b AS block_id, max(CASE WHEN p = 0 THEN tok END) AS x_first, max(CASE WHEN p = {block} THEN tok END) AS y_last,
       sum(CASE WHEN p < {block} THEN tok ELSE 0 END)::BIGINT AS x_sum,
       sum(CASE WHEN p > 0 THEN tok * (p - 1) ELSE 0 END)::BIGINT AS y_dot
FROM (SELECT (loc // {block})::BIGINT AS b, (loc % {block})::BIGINT AS p, tok FROM {tokens}
      UNION ALL SELECT (loc // {block} - 1)::BIGINT, {block}::BIGINT, tok FROM {tokens} WHERE loc % {block} = 0 AND loc > 0)
GROUP BY b HAVING count(*) = {block} + 1 {limit}"""


@query("scan_corpus", "SELECT doc_id, source, length(text) AS n_chars, md5(text) AS digest FROM documents")
def scan_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, "source").select(
        "doc_id", "source", F.char_length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest")
    )


_MIXED = "CASE doc_id % 15 WHEN 0 THEN chr(160) || chr(12288) WHEN 1 THEN '  ' || chr(10) WHEN 2 THEN chr(28) ELSE text END"


def mixed_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus with three kinds of blank text, each in place of every fifteenth document."""
    kind = F.col("doc_id") % 15
    text = F.when(kind == 0, "\u00a0\u3000").when(kind == 1, "  \n").when(kind == 2, "\x1c").otherwise(F.col("text"))
    return documents(spark, sf_dir).withColumn("text", text)


@query("drop_blank", f"""
SELECT doc_id, length(text) AS n_chars FROM (SELECT doc_id, {_MIXED} AS text FROM documents)
WHERE regexp_matches(text, '[^{SQL_SPACE}]')""")
def drop_blank_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_blank(mixed_blanks(spark, sf_dir), "text").select("doc_id", F.char_length("text").cast("long").alias("n_chars"))


@query("strip_text", f"""
SELECT doc_id, length(s) AS n_chars, md5(s) AS digest FROM (
  SELECT doc_id, regexp_replace(regexp_replace(t, '^[{SQL_SPACE}]+', ''), '[{SQL_SPACE}]+$', '') AS s
  FROM (SELECT doc_id, chr(12288) || chr(10) || text || chr(28) || '  ' || chr(160) AS t FROM documents))""")
def strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\u3000\n"), F.col("text"), F.lit("\x1c  \u00a0"))
    clean = documents(spark, sf_dir).select("doc_id", strip(padded).alias("s"))
    return clean.select("doc_id", F.char_length("s").cast("long").alias("n_chars"), F.md5(F.col("s").cast("binary")).alias("digest"))


@query("preview_text", """
SELECT doc_id, replace(left(text, 200), chr(10), ' ') AS preview FROM documents""")
def preview_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", preview(F.col("text"), 200).alias("preview"))


@query("encode_bytes", f"""
WITH {TOKENS_SQL}
SELECT t.doc_id, count(*)::BIGINT AS n_tokens, sum(tok)::BIGINT AS token_sum,
       max(CASE WHEN loc - start = n // 2 THEN tok END) AS middle_token, arg_max(tok, loc) AS last_token
FROM tokens t JOIN offsets o ON o.doc_id = t.doc_id GROUP BY t.doc_id""")
def encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = spread_documents(spark, sf_dir).select("doc_id", encode_bytes(F.col("text")).alias("tokens"))
    return encoded.select(
        "doc_id", F.size("tokens").cast("long").alias("n_tokens"), total(F.col("tokens")).alias("token_sum"),
        F.get("tokens", F.call_function("div", F.size("tokens"), F.lit(2)).cast("int")).alias("middle_token"),
        F.element_at("tokens", -1).alias("last_token"),
    )


# the pattern without look-ahead: a mark splits the last space off every longer run that is followed by text
_SPACE_RUN = SQL_SPACE.replace(r"\x1c-\x20", r"\x20")
_MARKED = rf"regexp_replace(text, '([{_SPACE_RUN}]+)([{_SPACE_RUN}])([^{_SPACE_RUN}])', '\1' || chr(57344) || '\2\3', 'g')"
_PIECES = (
    rf"'''(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE_RUN}\p{{L}}\p{{N}}\x{{E000}}]+|[{_SPACE_RUN}]+'"
)


@query("pretokenize", f"""
SELECT doc_id, len(p)::BIGINT AS n_pieces, md5(array_to_string(p, chr(57345))) AS digest
FROM (SELECT doc_id, regexp_extract_all({_MARKED}, {_PIECES}) AS p FROM documents)""")
def pretokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = corpus.spread(documents(spark, sf_dir), "doc_id").select("doc_id", bpe.pieces(F.col("text")).alias("p"))
    return cut.select(
        "doc_id", F.size("p").cast("long").alias("n_pieces"),
        F.md5(F.array_join("p", "\ue001").cast("binary")).alias("digest"),
    )


@query("roundtrip", f"""
SELECT count(*) AS documents, 0::BIGINT AS failures FROM documents WHERE regexp_matches(text, '[^{SQL_SPACE}]')""")
def roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread_documents(spark, sf_dir)
    back = docs.withColumn("back", decode_bytes(encode_bytes(F.col("text"))))
    return back.agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(F.when(F.col("back") == F.col("text"), 0).otherwise(1)).cast("long").alias("failures"),
    )


def merged_sql(texts: str, keys: str) -> str:
    """CTE ``merged`` (keys, piece, place, tok) of the byte-pair tokens of the texts in a CTE.

    Tokens are spelled ``<6874><65>``. Every merge of the sample gives only pairs that merge later, so
    replacing them in order is the merge order; a token that two pairs can give is replaced for both.
    """
    tokens = {bytes([b]): b for b in range(256)} | {m: 256 + i for i, m in enumerate(SAMPLE_MERGES)}
    chain = r"regexp_replace(hex(encode(piece)), '(..)', '<\1>', 'g')"
    for merged in SAMPLE_MERGES:
        for at in range(1, len(merged)):
            left, right = merged[:at], merged[at:]
            if left in tokens and right in tokens:
                chain = f"replace({chain}, '<{left.hex().upper()}><{right.hex().upper()}>', '<{merged.hex().upper()}>')"
    ids = ", ".join(f"'{t.hex().upper()}': {i}" for t, i in tokens.items() if len(t) > 1)
    return f"""cut AS (SELECT {keys}, regexp_extract_all({_MARKED}, {_PIECES}) AS p FROM {texts}),
parts AS (SELECT {keys}, unnest(p) AS piece, unnest(range(len(p))) AS i FROM cut),
spelled AS (SELECT {keys}, i, regexp_extract_all({chain}, '[0-9A-F]+') AS h FROM parts),
hexed AS (SELECT {keys}, i, unnest(h) AS h, unnest(range(len(h))) AS j FROM spelled),
merged AS (SELECT {keys}, i AS piece, j AS place,
  CASE WHEN length(h) = 2 THEN ('0x' || h)::INTEGER ELSE MAP {{{ids}}}[h] END AS tok FROM hexed)"""


_END = 256 + len(SAMPLE_MERGES)


@query("encode_merged", f"""
WITH {merged_sql("documents", "doc_id")}
SELECT doc_id, count(*) + 1 AS n_tokens, md5(string_agg(tok, ',' ORDER BY piece, place) || ',{_END}') AS digest FROM merged GROUP BY doc_id""")
def encode_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-pair ids of every document."""
    encoded = bpe.encode(spread_documents(spark, sf_dir), "doc_id", "text", bpe.Vocabulary.from_merges(SAMPLE_MERGES))
    joined = F.array_join(F.col("tokens").cast("array<string>"), ",")
    return encoded.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.md5(joined.cast("binary")).alias("digest"))


@query("decode_merged", "SELECT doc_id, md5(text) AS digest FROM documents")
def decode_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-pair tokens of every document read back as text."""
    vocabulary = bpe.Vocabulary.from_merges(SAMPLE_MERGES)
    docs = spread_documents(spark, sf_dir)
    back = bpe.decode(bpe.encode(docs, "doc_id", "text", vocabulary), "doc_id", vocabulary)
    return back.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("pack_merged", f"""
WITH {merged_sql("documents", "doc_id")}, ended AS (
  SELECT * FROM merged UNION ALL SELECT doc_id, (1::BIGINT << 40), 0, {_END} FROM (SELECT DISTINCT doc_id FROM merged)),
tokens AS (SELECT row_number() OVER (ORDER BY doc_id, piece, place) - 1 AS loc, tok FROM ended)""" + blocks_sql("tokens", BLOCK))
def pack_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.from_merges(SAMPLE_MERGES)
    docs = spread_documents(spark, sf_dir)
    encoded = cut_lineage(bpe.encode(docs, "doc_id", "text", vocabulary))  # read twice: for lengths and for pieces
    carrier = ArrayCarrier(vocabulary.end)
    tokens = F.col("tokens")
    return block_digest(packing.pack_blocks(encoded, "doc_id", tokens, carrier.count(tokens), carrier, BLOCK))


@query("token_totals", """
SELECT source, count(*) AS documents, sum(octet_length(encode(text)) + 1)::BIGINT AS tokens FROM documents GROUP BY source""")
def token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = drop_blank(documents(spark, sf_dir, "source"), "text")
    return docs.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(BYTES.text_count(F.col("text")) + 1).alias("tokens")
    )


@query("pack_blocks", f"WITH {TOKENS_SQL}" + blocks_sql("tokens", BLOCK))
def pack_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_digest(packed(spark, sf_dir))


_BUDGET = 700_000


@query("pack_budget", f"WITH {TOKENS_SQL}" + blocks_sql("tokens", 256, f"AND b < {-(-_BUDGET // 256)}"))
def pack_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of 256, stopped by a token budget."""
    return block_digest(packed(spark, sf_dir, 256, _BUDGET))


_PREFIX = 500_000


@query("prefix_eval", f"""WITH {TOKENS_SQL}, prefix AS (SELECT * FROM tokens WHERE loc < {_PREFIX})""" + blocks_sql("prefix", BLOCK))
def prefix_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    text = F.col("text")
    tokens = BYTES.concat(BYTES.from_text(text), BYTES.ending())
    return block_digest(
        packing.prefix_blocks(
            drop_blank(docs, "text"), "doc_id", tokens, BYTES.text_count(text) + 1, BYTES, BLOCK, _PREFIX, rows=docs.count()
        )
    )


@query("check_shift", f"""
WITH {TOKENS_SQL} SELECT ((count(*) - 1) // {BLOCK})::BIGINT AS blocks, 0::BIGINT AS violations FROM tokens""")
def check_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target shifted by one against input, over every block."""
    blocks = packed(spark, sf_dir)
    shifted = F.slice("x", 2, BLOCK - 1) == F.slice("y", 1, BLOCK - 1)
    return blocks.agg(
        F.count(F.lit(1)).alias("blocks"), F.sum(F.when(shifted, 0).otherwise(1)).cast("long").alias("violations")
    )


_HELD = "('0x' || substr(md5(text), 1, 8))::BIGINT % 10000 < 500"


@query("holdout_split", f"""
SELECT doc_id, CASE WHEN {_HELD} THEN 'validation' ELSE 'train' END AS split FROM documents""")
def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.holdout_split(documents(spark, sf_dir), "text", 0.05).select("doc_id", "split")


@query("source_counts", f"""
SELECT source, split, count(*) AS n FROM (
  SELECT source, CASE WHEN {_HELD} THEN 'validation' ELSE 'train' END AS split FROM documents)
GROUP BY ROLLUP (source, split)""")
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.source_counts(batching.holdout_split(documents(spark, sf_dir, "source"), "text", 0.05))


@query("union_sources", """
SELECT source, id, length(text) AS n_chars FROM (
  SELECT 'documents' AS source, doc_id AS id, text FROM documents
  UNION ALL SELECT 'benchmark', item_id, text FROM benchmark
  UNION ALL SELECT 'pages', page_id, html FROM pages)""")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = batching.union_sources(
        {
            "documents": load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"),
            "benchmark": load(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text"),
            "pages": load(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text")),
        }
    )
    return everything.select("source", "id", F.char_length("text").cast("long").alias("n_chars"))


_SHUFFLED = batching.epoch_sql("(SELECT doc_id FROM documents)", "doc_id", epoch=2, seed=7)


@query("epoch_shuffle", f"SELECT doc_id, position, 2::INTEGER AS epoch FROM {_SHUFFLED}")
def epoch_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id")
    return batching.epoch_order(docs, "doc_id", epoch=2, seed=7, rows=docs.count())


@query("make_batches", f"""
SELECT doc_id, (position // 48)::BIGINT AS batch FROM (SELECT *, count(*) OVER () AS n FROM {_SHUFFLED})
WHERE position < n - n % 48""")
def make_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = load(spark, sf_dir, "documents").count()
    return batching.make_batches(epoch_shuffle(spark, sf_dir), "position", 48, drop_last=True, total=total).select(
        "doc_id", "batch"
    )


_STEPS = """CASE WHEN doc_id % 10 = 0 THEN source || '/best.pt' WHEN doc_id % 10 = 1 THEN source || '/step_x.pt'
            ELSE source || '/step_' || doc_id || '.pt' END"""


@query("latest_artifact", rf"""
SELECT folder, arg_max(path, step) AS path, max(step) AS step FROM (
  SELECT path, regexp_replace(path, '/[^/]*$', '') AS folder, regexp_extract(path, '/step_(\d+)\.pt$', 1)::BIGINT AS step
  FROM (SELECT {_STEPS} AS path FROM documents) WHERE regexp_matches(path, '/step_\d+\.pt$'))
GROUP BY folder""")
def latest_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("doc_id") % 10
    name = F.when(kind == 0, F.lit("best")).when(kind == 1, F.lit("step_x")).otherwise(F.concat(F.lit("step_"), F.col("doc_id")))
    paths = load(spark, sf_dir, "documents").select(F.concat("source", F.lit("/"), name, F.lit(".pt")).alias("path"))
    return artifacts.latest_artifact(paths).select("folder", "path", "step")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")  # wall-clock time, whatever the session's zone
    return documents(spark, sf_dir, "source").select(
        F.col("doc_id").alias("step"), F.col("source").alias("prompt"), "text",
        F.timestamp_add("SECOND", F.col("doc_id") * 61, start).alias("ts"),
    )


@query("sample_log", """
SELECT doc_id AS step, source AS prompt, md5(left(text, 500)) AS digest,
       strftime(make_timestamp((1704067200 + doc_id * 61) * 1000000), '%Y-%m-%d %H:%M:%S') AS logged_at FROM documents""")
def sample_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = logs.sample_log(samples(spark, sf_dir))
    return logged.select("step", "prompt", F.md5(F.col("text").cast("binary")).alias("digest"), "logged_at")


@query("last_samples", """
SELECT doc_id AS step, source AS prompt, left(text, 300) AS text FROM documents ORDER BY doc_id DESC LIMIT 5""")
def last_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.last_samples(samples(spark, sf_dir)).select("step", "prompt", "text")
