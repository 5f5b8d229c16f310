"""Held-out accuracy, spans of mixed texts, and Viterbi against plain search."""

import itertools
import zlib

import numpy as np
import pytest

from ledgerline.llm import langid, text_queries  # noqa: F401
from ledgerline.llm.registry import QUERIES

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    return langid.train(docs.where(~langid.held_out(docs.doc_id)))


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    got = QUERIES["op5_languages"](spark, MEDIUM).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    judged = [r for r in got if r.held_out and truth[r.doc_id].lang]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in judged) >= 0.97 * len(judged)


def test_mixed_texts_are_cut(model):
    rows = {"en": "the and for this that with from have been was thing", "de": "der die und nicht mit einer auf für den schlich", "fr": "le la les dans pour avec une sur est ouvement"}
    text = " ".join(rows[x] for x in ("en", "de", "en", "fr"))
    (lang, score, spans), = model.label([text])
    assert lang == "en" and 0.3 < score < 0.7
    assert [s[2] for s in spans] == ["en", "de", "en", "fr"]
    assert sum(s[1] for s in spans) == len(text.split())


def test_viterbi_is_the_best_path():
    random = np.random.default_rng(1)
    texts = [random.normal(size=(n, 3)).astype(np.float32) for n in (4, 0, 1, 6, 4)]
    for scores, path in zip(texts, langid.viterbi(texts, 0.7), strict=True):
        def value(p, scores=scores):
            return sum(scores[t, x] for t, x in enumerate(p)) - 0.7 * sum(a != b for a, b in itertools.pairwise(p))
        assert len(path) == len(scores)
        assert value(path) == pytest.approx(max(map(value, itertools.product(range(3), repeat=len(scores)))), abs=1e-4)


def test_spelling_outlives_forgotten_words(model, monkeypatch):
    calls = []
    plain = langid.Model._gram
    monkeypatch.setattr(langid.Model, "_gram", lambda self, lang, gram: calls.append(gram) or plain(self, lang, gram))
    own = langid.Model(model.words, model.totals, model.grams)
    texts = ["the and für \U00020000x", "der thing ouvement the"]
    first = list(own.label(texts))
    own.places.update((str(n), 0) for n in range(langid.REMEMBERED + 1))
    met = len(calls)
    assert met and list(own.label(texts)) == first
    assert len(own.places) < 10 and len(calls) == met


def test_odd_rows(spark, model):
    texts = [None, "", "123 !? ²", "日本語の文", "the the", "x" * 50_000, "the of and " * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "the")], "doc_id long, text string").selectExpr("*", "'q' as lang_pred", "1 as SCORE")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0)] * 3
    assert got[3] == (model.languages[0], 0.0) and got[4][0] == "en" and got[6] == ("en", 1.0) and got[None][0] == "en"
    none = langid.train(docs.selectExpr("text", "cast(null as string) as lang"))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0
