"""Base spans against Python's own matcher; models against planted strings."""

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import secrets, text_queries  # noqa: F401
from ledgerline.llm.registry import QUERIES
from pyspark.sql import functions as F

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(out)


def spans(row, name):
    return [(s.start, s.kind, s.end) for s in row[name]]


TEXTS = [
    None, "", "é password = \"hunter2x\" and TOKEN:abc token:token:abcdef", "AKIA" + "A" * 16 + " AKIAAKIA" + "B2" * 8,
    "f" * 24 + "g" + "a1" * 20, "ap" "i_key='x.y=z-1'; APIKEY: 12345", "ſecret=abcdefgh toKen=abcdefgh", "𝒳 passwd=longenough",
    "secret='" + "0123456789abcdef" * 3 + "'",
]


def test_base_spans(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").withColumn("base", F.lit(1))
    got = {r.doc_id: spans(r, "base") for r in secrets.base_spans(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["token", "tok", "=", ":", " ", '"', "abcdef", "AKIA", "A1" * 9, "fade" * 7, "é", "x", "api_", "key"]), max_size=25).map("".join), min_size=20, max_size=60))
def test_any_text(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: spans(r, "base") for r in secrets.base_spans(docs).collect()} == {i: brute(t) for i, t in enumerate(texts)}


def test_query(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op4_secrets"](spark, small).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        base = brute(text)
        listed = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(s[1] == k for s in base) for k in range(3))
        assert got[i].base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(got[i].spans.split(","))


def test_models_tell_random_from_ordinary(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = secrets.train(secrets.labelled_strings(docs))
    pick = random.Random(4)
    symbols = secrets.ALPHABET[:64]
    planted = ["".join(pick.choice(symbols) for _ in range(36)) for _ in range(60)]
    plain = [w for r in docs.select("text").collect() for w in re.findall("[A-Za-z]{12,}", r.text or "")][:400]
    plain = ["_".join(pair) for pair in zip(plain[::2], plain[1::2], strict=True)]
    rows = [(i, f"é see {t} here") for i, t in enumerate(planted + plain)]
    found = {r.doc_id: spans(r, "spans") for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert sum(found[i] == [(6, 3, 42)] for i in range(60)) >= 57
    assert sum(bool(found[i]) for i in range(60, len(rows))) <= 2


def test_redaction_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, TEXTS[-1] + " tail"), (2, "clean"), (3, None)], "doc_id long, text string")
    cut = secrets.base_spans(docs).withColumn("text", secrets.redacted(F.col("text"), F.col("base")))
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "[SECRET]' tail", 2: "clean", 3: None}
    model = secrets.train(secrets.labelled_strings(docs.limit(0)))
    assert secrets.scan(docs.limit(0), model).count() == 0


def test_short_random_strings(spark, small):
    """Keys of 10 to 19 characters, against all words of those lengths, headings in capitals among them."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = secrets.train(secrets.labelled_strings(docs))
    pick = random.Random(5)
    planted = ["".join(pick.choice(secrets.ALPHABET[:62]) for _ in range(n)) for n in range(10, 20) for _ in range(20)]
    plain = sorted({w for r in docs.select("text").collect() for w in re.findall("[A-Za-z]{10,19}", r.text or "")})
    plain += [w.upper() for w in plain]
    rows = [(i, f"é see {t} here") for i, t in enumerate(planted + plain)]
    found = {r.doc_id: spans(r, "spans") for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert sum(found[i] == [(6, 3, 6 + len(t))] for i, t in enumerate(planted)) >= 190
    assert sum(bool(found[i]) for i in range(len(planted), len(rows))) <= 0.01 * len(plain)
