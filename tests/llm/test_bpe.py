"""Against the reference library's own encoder, and the exact round trip."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import bpe
from ledgerline.llm.registry import QUERIES
from ledgerline.llm import text_queries  # noqa: F401

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = ["", " ", "a", "  a  b ", "It's we'll\n\n x", "été  façon\t\tñ", "a" * 700, "ab" * 3000, "é" * 900, "x y z \x1c q", "日本 語", "12345 678!!! ??", "\n", "a \nb", "a\n b", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocab():
    with open(PATH, "rb") as file:
        return bpe.Vocabulary(file.read(), PATTERN)


def ids(found):
    return [np.frombuffer(x, "<i4").tolist() for x in found]


def test_same_ids_as_the_library(vocab, library):
    assert ids(vocab.encode(TEXTS)) == [library.encode_ordinary(t) for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tabcdeéñ'st.,1日  ", max_size=60), max_size=5))
def test_any_text(vocab, library, texts):
    found = vocab.encode(texts)
    assert ids(found) == [library.encode_ordinary(t) for t in texts]
    assert [vocab.decode(np.frombuffer(x, "<i4"))[0].tobytes().decode() for x in found] == texts


def test_query(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op10_bpe"](spark, small).collect()}
    assert len(got) == len(docs)
    for r in docs:
        own = library.encode_ordinary(r.text or "")
        want = hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest()
        plain = hashlib.sha256((r.text or "").encode()).hexdigest()
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == (len(own), want, plain)


def test_nulls_repeats_clashes_and_nothing(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "ab c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    out = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted((bytes(r.decoded), len(r.ids)) for r in out) == [(b"", 0), (b"", 0), (b"ab c", 2)]
    assert bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0
