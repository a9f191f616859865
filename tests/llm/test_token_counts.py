import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from breachline.llm import token_counts
from breachline.llm.token_counts import Pieces, count_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PIECES = Pieces(PATH)
ODD = " ▁  abcétheingTHE\t\n日本語𝔘0123</s><s><0x41>\x00ạ́﻿"


@settings(max_examples=400, deadline=None)
@given(st.text(ODD, max_size=40) | st.text(max_size=40) | st.text(" the▁", max_size=60))
def test_counts_equal_the_library(text):
    assert PIECES.count(text) == len(LIBRARY.encode(text))


def test_slices_do_not_change_counts(monkeypatch):
    text = "some words  and   spaces, with a_very_long_word_" + "x" * 300 + " and the end " * 30
    for size in (1, 5, 40):
        monkeypatch.setattr(token_counts, "_SLICE", size)
        assert PIECES.count(text) == len(LIBRARY.encode(text))


def test_full_cache_is_emptied(monkeypatch):
    monkeypatch.setattr(token_counts, "_KEPT", 3)
    pieces = Pieces(PATH)
    assert pieces.count("a b c d e f a b c d") == len(LIBRARY.encode("a b c d e f a b c d"))
    assert len(pieces.seen) <= 3


def test_table(spark):
    rows = [(1, "Hello world"), (2, None), (3, ""), (None, "é" * 10), (4, "word " * 5000), (4, "word " * 5000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    got = sorted(map(tuple, count_tokens(frame, PATH).collect()), key=repr)
    want = []
    for d, t in rows:
        n = len(LIBRARY.encode(t or ""))
        want.append((d, len((t or "").encode()), n, n > 4096))
    assert got == sorted(want, key=repr)
    assert count_tokens(frame.limit(0), PATH).count() == 0


def test_limit_is_exclusive(spark):
    frame = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    n = count_tokens(frame, PATH).first()["n_tokens"]
    assert not count_tokens(frame, PATH, n).first()["over_limit"]
    assert count_tokens(frame, PATH, n - 1).first()["over_limit"]


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in count_tokens(docs, PATH).collect():
        assert r["n_tokens"] == len(LIBRARY.encode(texts[r["doc_id"]]))


def test_vocabulary_with_pieces_across_words_is_refused(monkeypatch):
    class Model:
        def __init__(self, model_file):
            pass

        get_piece_size = staticmethod(lambda: 1)
        id_to_piece = staticmethod(lambda i: "a▁b")
        get_score = staticmethod(lambda i: -1.0)
        is_control = is_unknown = is_byte = is_unused = staticmethod(lambda i: False)

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Model)
    with pytest.raises(ValueError):
        Pieces("any")
