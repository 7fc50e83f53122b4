"""Byte-level BPE against tiktoken, language identification on held-out rows."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_SMALL

import __spark_entry__ as E
from maskweave.llm import bpe, language_id

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = ["", None, "a\x00b\n\n  c  ", "a" * 70, "日本語 😀😀", "don't   we'LL", " " * 40 + "x", "=" * 300, "é" * 2000,
         "long words " * 30_000, "​﻿ x²½"]


def test_bpe_like_tiktoken(spark):
    vocabulary = bpe.Vocabulary.load(PATH)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks,
                            special_tokens={})
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH).collect()}
    for k, t in enumerate(TEXTS):
        assert np.frombuffer(got[k].ids, "<u4").tolist() == own.encode_ordinary(t or "")
        assert bytes(got[k].decoded) == (t or "").encode()
    both = {r.doc_id: r for r in bpe.round_trip(df, PATH, public_tokenizers.PATTERN).collect()}
    assert {k: (r.ids, r.decoded) for k, r in both.items()} == {k: (r.ids, r.decoded) for k, r in got.items()}
    assert bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_bpe_forgets_words_without_effect(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    coder = bpe.Encoder(bpe.Vocabulary.load(PATH))
    coder.learn({"hello", "worldly", "unheard"})
    first = dict(coder.known)
    coder.learn({"another", "worldly"})
    coder.learn({"worldly"})
    assert coder.known["worldly"] == first["worldly"]


def test_bpe_refuses_incomplete_vocabulary():
    with pytest.raises(ValueError):
        bpe.Vocabulary(b"YQ== 0\n")


def test_language_held_out_accuracy(spark):
    truth = dict(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang").collect())
    rows = E.queries()["op10_language_id"](spark, SF_SMALL).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_edges(spark):
    rows = [(1, "der die und das ist nicht", "de", "s"), (2, "the and of to is not", "en", "s"), (3, None, "en", "s"),
            (4, "", None, "s"), (5, "123 !!", "de", "s"), (6, "the " * 50_000, None, "s"), (6, "the and", "en", "s"),
            (None, "nicht und", None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = language_id.fit(df)
    out = language_id.predict(df, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "ambiguous"]
    got = [(r.doc_id, r.lang_pred) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, "de"), (2, "en"), (3, "und"), (4, "und"), (5, "und"), (6, "en"),
                                           (6, "en"), (None, "de")], key=str)
    assert language_id.predict(df.limit(0), model).count() == 0
    nothing = language_id.fit(df.where("lang = 'xx'"))
    assert {r.lang_pred for r in language_id.predict(df, nothing).collect()} == {"und"}


def test_one_language_and_many(spark):
    df = spark.createDataFrame([(1, "abc", "en")], "doc_id long, text string, lang string")
    assert language_id.predict(df, language_id.fit(df)).first().lang_pred == "en"
    code = language_id.codewords(20)
    assert len({tuple(r) for r in code}) == 20


def test_ambiguous_text_is_flagged(spark):
    df = spark.createDataFrame([(1, "aaa bbb", "x"), (2, "aaa bbb", "y"), (3, "ccc", "z")],
                               "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in language_id.predict(df, language_id.fit(df)).collect()}
    assert rows[1].ambiguous and not rows[3].ambiguous
