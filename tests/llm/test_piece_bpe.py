import random
import time

import public_tokenizers
import pytest
import sentencepiece

from loomframe.llm import piece_bpe as pb

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["  ", "▁", "▁▁", " ", "\n", "é", "日", "\U0001f600", "a", "th", "the", "ing", " a", "\t", "\x00", "<s>", "   ", "Z9", "ｆ", "́", "<0x0A>", "22", "\r"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return pb.PieceModel(open(PATH, "rb").read())


def test_random_text(library, own):
    pick = random.Random(1)
    for _ in range(5000):
        text = "".join(pick.choices(PARTS, k=pick.randint(0, 14)))
        ids = own.encode(text)
        assert ids.tolist() == library.encode(text), repr(text)
        assert own.decode(ids) == library.decode(ids.tolist()), repr(text)


def test_words_that_need_backtracking(library, own):
    pick = random.Random(2)
    pieces = [p for p in own.spelled if p.isascii() and p.isalpha()]
    words = ["".join(pick.choices(pieces, k=pick.randint(2, 5))) for _ in range(5000)]
    assert [own.encode(w).tolist() for w in words] == library.encode(words)


@pytest.mark.parametrize("window", [8, 512])
def test_windows(library, own, monkeypatch, window):
    monkeypatch.setattr(pb, "WINDOW", window)
    pick = random.Random(4)
    pieces = [p for p in own.spelled if p.isascii() and p.isalpha()]
    words = ["".join(pick.choices(pieces, k=pick.randint(1, 400))) for _ in range(200)]
    assert [own.encode(w).tolist() for w in words] == library.encode(words)


def test_a_word_of_two_million_letters(library, own):
    pick = random.Random(5)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "ab", "theing"):
        times = []
        for size in (200_000, 2_000_000):
            word = "".join(pick.choices(letters, k=size))
            began = time.process_time()
            ids = own.encode(word)
            times.append(time.process_time() - began)
            assert ids.tolist() == library.encode(word)
        assert times[1] < 25 * times[0]  # ten times the letters


def test_pairs_fit_as_merging_says(own):
    pick = random.Random(3)
    pieces = sorted(p for p in own.spelled if p not in own.tied)
    for _ in range(5000):
        pair = pick.choice(pieces), pick.choice(pieces)
        if not own.has_tied("".join(pair)):
            assert own.fits[pair] == (own.merge("".join(pair)) == list(pair)), pair


def test_frame(spark, library):
    long = "the quick brown fox " * 20_000
    texts = [None, "", " ", "plain words", "plain words", "x" * 5000, long, " " * 3000 + "end"]
    rows = [(k, t, "mine") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = pb.encode(df, PATH, decoded="decoded").orderBy("doc_id").collect()
    assert [r["ids"] for r in got] == [library.encode(t or "") for t in texts]
    assert [r["decoded"] for r in got] == [library.decode(library.encode(t or "")) for t in texts]
    assert [r["text"] for r in got] == texts
    assert pb.encode(df.limit(0), PATH).collect() == []
    back = pb.decode(pb.encode(df, PATH), PATH, text="back").orderBy("doc_id").collect()
    assert [r["back"] for r in back] == [t or "" for t in texts]
