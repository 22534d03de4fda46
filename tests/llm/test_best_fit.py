import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from loomframe.llm import best_fit as bf

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(sizes, capacity):
    """Room left in each bin, one piece at a time."""
    bins = []
    for size in sorted(sizes, reverse=True):
        fits = [room for room in bins if room >= size]
        if fits:
            bins.remove(min(fits))
            bins.append(min(fits) - size)
        else:
            bins.append(capacity - size)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_fit_decreasing(seed):
    pick = random.Random(seed)
    capacity = pick.choice([5, 10, 17, 64, 100])
    sizes = [pick.randint(1, capacity) for _ in range(pick.randint(0, 80))]
    filled = defaultdict(int)
    for line in bf.plan(Counter(sizes), capacity):
        for rank in range(line.low, line.high):
            sequence = line.first + (rank - line.low) // line.each
            assert filled[sequence] == line.base + (rank - line.low) % line.each * line.length
            filled[sequence] += line.length
    assert sorted(capacity - x for x in filled.values()) == brute(sizes, capacity)


def test_plan_size_depends_on_the_capacity():
    pick = random.Random(1)
    counts = Counter(pick.randint(1, 1024) for _ in range(100_000))
    small, large = len(bf.plan(counts)), len(bf.plan({k: 1000 * n for k, n in counts.items()}))
    assert large < 4 * small < 20_000


@pytest.mark.parametrize("size", [0, 1025])
def test_impossible_pieces(size):
    with pytest.raises(ValueError):
        bf.plan({size: 1})


def test_room_tree():
    tree = bf.RoomTree(100)
    for room in (3, 40, 41, 100):
        tree.add(room, 2)
    tree.add(40, -2)
    assert [tree.tightest(s) for s in (1, 3, 4, 41, 42, 100)] == [3, 3, 41, 41, 100, 100]
    tree.add(100, -2)
    assert tree.tightest(42) is None


def test_ids_are_those_of_the_library():
    library, own = tokenizers.Tokenizer.from_file(PATH), bf.Vocabulary(open(PATH, "rb").read())
    pick = random.Random(2)
    parts = ["<|endoftext|>", " ", "  ", "\n", "a", " the", "'s", "é", "日", " ", "12", "!?", "\t", "\x1c", "x" * 9]
    texts = ["".join(pick.choices(parts, k=pick.randint(0, 12))) for _ in range(1500)]
    assert [own.encode(t).tolist() for t in texts] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_pack(spark, monkeypatch):
    monkeypatch.setattr(bf, "ROWS_PER_BUCKET", 20)
    pick = random.Random(3)
    texts = [None, "", "one", "word " * 5000] + [" ".join(pick.choices(["alpha", "beta", "gamma"], k=pick.randint(0, 400))) for _ in range(150)]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(200, "same", "x"), (200, "same", "x"), (None, "none", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset string").repartition(6)
    got = bf.pack(df, PATH, capacity=128).collect()
    library = tokenizers.Tokenizer.from_file(PATH)
    want = Counter()
    for key, text, _ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 128 + 1
        cuts = [0, *range(first, len(ids) + 1, 128)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[key, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 128
    assert sorted(128 - sum(n for _, n in p) for p in by.values()) == brute([r["length"] for r in got], 128)


def test_empty_table_and_ids(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bf.pack(df, PATH).collect() == []
    one = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    row = bf.token_pieces(one, PATH, with_ids=True).first()
    assert row["ids"] == [*tokenizers.Tokenizer.from_file(PATH).encode("hello world").ids, 2]


LONG_TEXTS = {
    "blanks": " " * 2_000_000, "line ends": "\n" * 1_000_000, "run at the end": "some words" + " \n" * 600_000,
    "run before a letter": "a" + "\n" * 1_100_001 + "b c", "run before a special string": "x" + "\n" * 1_100_001 + "<|endoftext|>y",
    "several runs": ("w" + "\n" * 150_001) * 3 + "\t" * 120_000 + "!", "other blanks": "\u3000\xa0" * 600_000 + "z",
}


@pytest.mark.parametrize("name", LONG_TEXTS)
def test_long_runs_of_blanks(name):
    with open(PATH, "rb") as file:
        vocabulary = bf.Vocabulary(file.read())
    got = vocabulary.encode(LONG_TEXTS[name])
    assert np.array_equal(got, vocabulary.whole.encode(LONG_TEXTS[name], add_special_tokens=False).ids)


def test_long_runs_in_a_job(spark):
    rows = [(1, " " * 1_200_000), (2, "a" + "\n" * 1_000_001 + " b"), (3, "short")]
    got = bf.token_pieces(spark.createDataFrame(rows, "doc_id long, text string"), PATH).groupBy("doc_id").sum("length").collect()
    whole = tokenizers.Tokenizer.from_file(PATH)
    assert sorted(map(tuple, got)) == [(k, len(whole.encode(t, add_special_tokens=False).ids) + 1) for k, t in rows]
