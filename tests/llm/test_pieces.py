"""Merge rounds against the sentencepiece library: ids and decoded texts."""

import hashlib
import random

import pytest
import sentencepiece

from helpers import edge_docs, empty_docs, sf_docs
from tidelog.llm import piece_bpe


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe.model_path())


@pytest.fixture(scope="module")
def model():
    return piece_bpe.PieceModel(piece_bpe.model_path())


ALPHABETS = ["abcdefgh iorntes", "  ▁ab", "the and of ing er on\n\t\r", "日本語の 한국 русский год", "é　﻿ \x00\x01 x",
             "aaaa b", "()[]{}==//<<>>  \n", "😀🎉 �́a", " \na"]


def test_random_texts_equal_the_library(model, library):
    rnd = random.Random(2)
    pieces = [library.id_to_piece(i) for i in range(300, 32000)]
    texts = ["", " ", "  ", "\n", "▁", " ▁ "]
    for _ in range(1500):
        texts.append("".join(rnd.choice(rnd.choice(ALPHABETS)) for _ in range(rnd.randint(0, 80))))
        alphabet = rnd.choice(ALPHABETS)
        texts.append("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))))
        texts.append("".join(rnd.choice(pieces) * rnd.randint(1, 3) for _ in range(6)))
    for t in texts:
        ids = library.encode(t)
        assert model.encode(t) == ids, repr(t)
        assert model.decode([*ids, 2]) == library.decode([*ids, 2]), repr(t)
    for t, words in zip(texts, model.encoded(texts)):
        assert " ".join(d for d, _, _ in words) == " ".join(map(str, library.encode(t)))
        assert "".join(x for _, _, x in words)[1:] == library.decode(library.encode(t))


def test_ids_of_any_order_decode_like_the_library(model, library):
    rnd = random.Random(3)
    for _ in range(1500):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(0, 259)]) for _ in range(rnd.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids), ids


def test_long_words_by_heap_and_by_rounds(model, library, monkeypatch):
    rnd = random.Random(4)
    words = [" " * 9000, "a" * 7001, "ab" * 4000, "".join(rnd.choice("abcdefghi") for _ in range(6000)), "x y " * 3000]
    for w in words:
        assert model.encode(w) == library.encode(w)
    short = ["".join(rnd.choice("aeinrst ") for _ in range(60)) for _ in range(300)]
    expected = [library.encode(t) for t in short]
    monkeypatch.setattr(piece_bpe, "LONG", 0)
    assert [model.encode(t) for t in short] == expected


def test_a_full_cache_starts_anew(model, library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "CACHE_WORDS", 5)
    texts = ["one two three four five six seven", "eight nine ten one", "", "two"]
    for _ in range(2):
        for t, words in zip(texts, model.encoded(texts)):
            assert " ".join(d for d, _, _ in words) == " ".join(map(str, library.encode(t)))


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.mark.parametrize("make", [edge_docs, sf_docs])
def test_digests_and_ids_of_tables(spark, library, make):
    docs = make(spark)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    expected = []
    for i, t in rows:
        ids = library.encode(t) + [2]
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    order = lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:]))
    out = piece_bpe.digests(docs)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, out.collect()), key=order) == sorted(expected, key=order)
    whole = [(r["doc_id"], len(r["ids"]), sha(" ".join(map(str, r["ids"]))), sha(r["decoded"]))
             for r in piece_bpe.encoded(docs).collect()]
    assert sorted(whole, key=order) == sorted(expected, key=order)


def test_empty_table_and_string_ids(spark):
    assert piece_bpe.digests(empty_docs(spark)).collect() == []
    one = spark.createDataFrame([("x", "a b")], "doc_id string, text string")
    assert piece_bpe.digests(one).first()["doc_id"] == "x"
