"""The pipeline on a small corpus: every stage against what its operator says, decisions in effect."""

import pytest

import corpus_pipeline as cp
from loomframe.llm import minhash
from test_minhash import brute as groups
from test_substring_dedup import brute as passages

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = cp.documents(spark, SF_DIR)
    out = [docs]
    for _, stage in cp.STAGES:
        docs = cp.cut_lineage(stage(spark, docs, SF_DIR))
        out.append(docs)
    return out


def test_columns_and_shrinking(stages):
    assert all(d.columns == stages[0].columns for d in stages[:-1])
    counts = [d.count() for d in stages[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[1] >= counts[2] > counts[3] == counts[4] > 0


def test_near_duplicates(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    kept = {k for k, _, _, stays in groups(rows, minhash.SHINGLE, minhash.PERCENT) if stays}
    assert {r["doc_id"] for r in stages[3].collect()} == kept


def test_passages(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[3].collect()]
    texts = dict(rows)
    got = {r["doc_id"]: r for r in stages[4].collect()}
    for key, _, removed, kept in passages(rows, 20):
        assert got[key]["text"] == (kept if removed else texts[key])
        assert got[key]["n_chars"] == len(got[key]["text"])


def test_packing(stages):
    packed = stages[5].collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in stages[4].collect()}
    assert sum(r["length"] for r in packed) <= 1024 * len({r["sequence_id"] for r in packed})


def test_run_is_the_stages(spark, stages):
    def key(df):
        return sorted(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in df.collect())

    assert key(cp.run(spark, SF_DIR)) == key(stages[5])


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_take_nulls_copies_and_empty_tables(spark):
    words = " ".join(f"w{i}" for i in range(90))
    rows = [
        (1, words, "en", "s", 1), (1, words, "en", "s", 1), (2, words, None, None, None), (None, words + " more", None, "s", 2), (3, None, "en", "s", None),
        (4, "", None, None, 0), (5, " ".join(f"v{i}" for i in range(30_000)), "de", "s", 9),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in cp.STAGES[:-1]:
        for table in (docs, docs.limit(0)):
            got = stage(spark, table, SF_DIR)
            assert got.columns == docs.columns
            kept = {(r["doc_id"], r["source"]) for r in got.collect()}
            assert kept <= {(r[0], r[3]) for r in rows}
    assert {r["doc_id"] for r in cp.distinct_documents(spark, docs, SF_DIR).collect()} == {1, None, 3, 4, 5}
    assert {r["doc_id"] for r in cp.quality(spark, docs, SF_DIR).collect()} == {1, 2, None, 5}
    assert {r["doc_id"] for r in cp.packed(spark, docs, SF_DIR).collect()} == {1, 2, None, 3, 4, 5}
    assert cp.packed(spark, docs.limit(0), SF_DIR).collect() == []
    removed = {(r["doc_id"], r["text"]) for r in cp.distinct_passages(spark, docs, SF_DIR).collect()}
    assert removed == {(1, words), (2, ""), (None, words + " more"), (3, None), (4, ""), (5, rows[-1][1])}
