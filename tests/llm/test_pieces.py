"""Ids against the installed library, and exact round trips."""

import random

import numpy as np
import pytest

from ledgerline.llm import pieces as P

ODD = ["", "  ", " a", "a  b   c", " \n ", "x" * 3000, "日本語 text 😀", "\u0000a", "  leading",
       "trailing  ", "tHe <s> </s> <unk> <0x41>", "é" * 500, "​﻿"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=P.model_bytes())


def test_ids_equal_the_library(library):
    rng = random.Random(1)
    alphabet = "abcdefghijklmnop  THE  e\n\t.,!0123éüñ日本😀"
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(90))) for _ in range(2000)]
    pieces = P.Pieces(P.model_bytes())
    flat, off = pieces.encode(texts)
    assert [flat[a:z].tolist() for a, z in zip(off, off[1:])] == library.encode(texts)
    assert pieces.decode(flat, off) == texts


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(P, "CACHE_BYTES", 200)
    monkeypatch.setattr(P, "CACHE_PAIRS", 2)
    monkeypatch.setattr(P, "LONG_WORD", 40)
    monkeypatch.setattr(P, "HASH_BYTES", 64)
    pieces = P.Pieces(P.model_bytes())
    for text in ODD * 2 + ["the same words as the words of the text " * 9]:
        assert pieces.encode([text])[0].tolist() == library.encode(text)
    flat, off = pieces.encode(ODD)
    assert [flat[a:z].tolist() for a, z in zip(off, off[1:])] == library.encode(ODD)


def test_marks_in_a_text_count_as_spaces(library):
    pieces = P.Pieces(P.model_bytes())
    texts = ["a\u2581b", "\u2581", "x \u2581 y", "plain"]
    flat, off = pieces.encode(texts)
    assert [flat[a:z].tolist() for a, z in zip(off, off[1:])] == library.encode(texts)


def test_long_words_stay_within_bounds(library):
    """Texts without spaces: words of 20,000 characters are cut, not remembered."""
    rng = random.Random(8)
    pieces = P.Pieces(P.model_bytes())
    for _ in range(30):
        text = "".join(rng.choices("abcdefghijklmnop日é", k=20_000))
        assert pieces.encode([text])[0].tolist() == library.encode(text)
    assert pieces._words.nbytes() < 1000 and len(pieces._pairs) <= P.CACHE_PAIRS + 20_000


def test_forgetting_keeps_the_used_words(library, monkeypatch):
    monkeypatch.setattr(P, "CACHE_BYTES", 20_000)
    pieces = P.Pieces(P.model_bytes())
    rng = random.Random(4)
    for k in range(40):
        texts = ["common words come again " + "".join(rng.choices("abcdefgh ", k=200)) for _ in range(5)]
        flat, off = pieces.encode(texts)
        assert [flat[a:z].tolist() for a, z in zip(off, off[1:])] == library.encode(texts)
        assert pieces._words.nbytes() <= 20_000
    assert pieces._words.used.max() >= 10


def test_unigram_state_is_the_best_sum():
    """Shared-prefix states give the best sum of scores that brute force finds."""
    pieces = P.Pieces(P.model_bytes(), kind="unigram")
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("theand", k=rng.randrange(1, 9))) for _ in range(200)})

    def best(w):
        if not w:
            return 0.0
        return max(best(w[n:]) + pieces.scores.get(w[:n], pieces.floor if n == 1 else -1e18)
                   for n in range(1, len(w) + 1))
    for word, cut in pieces._cuts(words):
        assert "".join(cut) == word
        assert np.isclose(sum(pieces.scores.get(p, pieces.floor) for p in cut), best(word))


def test_tables(spark, library, monkeypatch):
    rows = [(i, t, "x") for i, t in enumerate([None, *ODD, "a b", "a b"])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids2 string")
    model = P.model_bytes()
    coded = P.encode_pieces(df, model)
    once = {r.doc_id: r for r in P.encode_pieces(df, model, decoded_col="decoded").collect()}
    back = {r.doc_id: r for r in P.decode_pieces(coded, model).collect()}
    for i, t, _ in rows:
        assert back[i].ids == once[i].ids == (None if t is None else library.encode(t))
        assert back[i].decoded == once[i].decoded == t
    assert P.decode_pieces(P.encode_pieces(df.limit(0), model), model).count() == 0
