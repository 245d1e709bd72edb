from __future__ import annotations

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigora.llm import tokens as K

PATH = f"{K.VOCABULARIES}/{K.VOCABULARY}"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary file")


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_pieces_give_the_ids_of_the_whole_and_bytes_come_back(text):
    enc = K.encoder(PATH)
    assert "".join(K.pieces(text)) == text
    ids = np.frombuffer(K.encode(text, K.piece_ids(PATH)), np.int32)
    assert list(ids) == enc.encode_ordinary(text)
    assert K.decode(ids, enc) == text.encode()


def test_special_strings_and_long_texts_are_ordinary():
    known, enc = K.piece_ids(PATH), K.encoder(PATH)
    for text in ("<|endoftext|> a", "x" * 30_000, " \t\n" * 9_000, "ação, nº 4.567 " * 9_000, "á​﻿"):
        assert list(np.frombuffer(K.encode(text, known), np.int32)) == enc.encode_ordinary(text)


def test_cut_within_a_character():
    ids = np.frombuffer(K.encode("日本語", K.piece_ids(PATH)), np.int32)
    enc = K.encoder(PATH)
    assert b"".join(K.decode(ids[i : i + 1], enc) for i in range(len(ids))).decode() == "日本語"


def test_tables(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 3), (3, "Olá mundo", 3), (3, "Olá mundo", 3)], "doc_id int, text string, n_tokens int")
    got = K.encode_texts(docs).collect()
    assert sorted((r["doc_id"], len(r["ids"])) for r in got)[:2] == [(1, 0), (2, 0)] and len(got) == 4
    counted = K.count_tokens(docs.drop("n_tokens"))
    assert {r["doc_id"]: r["n_tokens"] for r in counted.collect()}[3] == len(got[-1]["ids"])
    back = K.decode_ids(K.encode_texts(docs)).where("doc_id = 3").first()
    assert bytes(back["bytes"]).decode() == "Olá mundo"
    assert K.encode_texts(docs.where(F.lit(False))).collect() == []
    assert "n_tokens" in K.count_tokens(docs).columns and K.count_tokens(docs).columns.count("n_tokens") == 1
