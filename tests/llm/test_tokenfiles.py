"""Against the tokenizer library on whole texts, and exact round trips through the files."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import data_queries, tokenfiles  # noqa: F401
from ledgerline.llm.registry import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(PATH)
    out.encode_special_tokens = True
    return lambda text: out.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as file:
        return tokenfiles.Encoder(file.read())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAbΣςσéÉ  \x1c\x85 \n\t\r.,'sß1İ日<|endoftext|>", max_size=60))
def test_words_encode_as_texts_do(library, own, text):
    (found,) = own.encode([text])
    assert np.frombuffer(found, own.dtype).tolist() == library(text)


WORDS = ["the", "thing,", "I\u0307x", "\u0130stanbul", "don't", "we'll.", "a_b", "\u00b2x", "\u65e5\u672c", "Stra\u00dfe;", "e\u0301t\u00e9", "x\u0301", "!!", "3rd", "", "\u03a3\u03c3\u03c2", "<|endoftext|>", "</w>", "a</w>", "\u1e9e.", "\ufb01n"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=30))
def test_words_of_every_kind(library, texts):
    with open(PATH, encoding="utf-8") as file:
        fresh = tokenfiles.encoder(file.read())
    fresh.known.clear()
    text = " ".join(texts)
    (found,) = fresh.encode([text])
    assert np.frombuffer(found, fresh.dtype).tolist() == library(text)


def test_query(spark, small, library):
    docs = sorted(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in QUERIES["op6_token_files"](spark, small).collect()}
    assert len(got) == len(docs)
    start = 0
    for doc, text in docs:
        ids = np.array([*library(text or ""), 1], "<u4")
        assert tuple(got[doc])[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_access_by_key(spark, folder, library, monkeypatch):
    monkeypatch.setattr(tokenfiles, "SHARD_BYTES", 64)
    monkeypatch.setattr(tokenfiles, "BUCKET", 20)
    rows = [(i * 7, f"text number {i}") for i in range(150)] + [(14, "again"), (14, None), (None, "x"), (None, "x"), (-5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as copy", "3 as bucket")
    tokenfiles.write(docs, f"{folder}/t", PATH, end=1)
    asked = spark.createDataFrame([(7, 0), (7, 0), (14, 0), (14, 1), (14, 2), (14, 3), (-5, 0), (5, 0), (None, 0)], "key long, copy int")
    got = {(r.key, r.copy): r.ids for r in tokenfiles.fetch(spark, f"{folder}/t", asked).collect()}
    assert got == {(7, 0): [*library("text number 1"), 1], (14, 0): [1], (14, 1): [*library("again"), 1], (14, 2): [*library("text number 2"), 1], (-5, 0): [1]}
    assert tokenfiles.checksums(spark, f"{folder}/t").count() == len(rows)


def test_perfect_hash():
    keys = np.concatenate([np.arange(5000), np.arange(5000)])
    copies = np.repeat([0, 1], 5000)
    table = tokenfiles.PerfectHash.build(keys, copies)
    assert sorted(table.slots(keys, copies).tolist()) == list(range(10_000))
    with pytest.raises(ValueError):
        tokenfiles.PerfectHash.build(np.array([3, 3]), np.array([0, 0]))


def test_nothing(spark, folder):
    docs = spark.createDataFrame([], "doc_id long, text string")
    tokenfiles.write(docs, f"{folder}/t", PATH, end=1)
    asked = spark.createDataFrame([(1, 0)], "key long, copy int")
    assert tokenfiles.fetch(spark, f"{folder}/t", asked).count() == 0
    assert tokenfiles.shard_starts(spark, f"{folder}/t").count() == 0


def test_documents_without_a_key(spark, folder, library):
    """One row each, before all others."""
    rows = [(3, "three"), (None, "no key"), (None, None), (1, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in QUERIES["op6_token_files"](spark, folder).collect())
    none, three = len(library("no key")), len(library("three"))
    assert got == [(0, None, 1), (1, None, none + 1), (none + 2, 1, 1), (none + 3, 3, three + 1)]
