"""Against brute force, and against the SQL of the query."""

import hashlib
import re

import duckdb

from ledgerline.llm import decontaminate, text_queries  # noqa: F401
from ledgerline.llm.registry import QUERIES, SQL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for item, other in items:
            other = words(other)
            k = min(13, len(other))
            windows = {tuple(other[i : i + k]) for i in range(len(other) - k + 1)} if k else set()
            for i in range(len(own) - k + 1) if k else ():
                if tuple(own[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    found.add(item)
        out.append((doc, len(own), len(hit), sorted(map(str, found - {None}))))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.id, r.n_words, r.n_hit, r["items"]) for r in df.collect()), key=str)


ITEMS = [(1, " ".join(f"a{i}" for i in range(20))), (20, "Short one here"), (3, "solo"), (4, None), (5, "..."), (10, "short ONE here"), (6, "É é ok")]
DOCS = [
    (1, "x " + " ".join(f"A{i}" for i in range(3, 18)) + " y"),
    (2, "short one here, short one here! solo"),
    (3, None),
    (4, ""),
    (5, "é é ok É é ok"),
    (6, " ".join(f"a{i}" for i in range(12))),
    (7, "short one"),
    (8, "solo solo short one here"),
]


def test_small_cases(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 as hash", "2 as words", "3 as items")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert got(decontaminate.hits(docs, items)) == brute(DOCS, ITEMS)


def test_windows_in_slices(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ANCHORS", 3)
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert got(decontaminate.hits(docs, items)) == brute(DOCS, ITEMS)


def test_query_and_sql(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0 and 20 * h >= n) for d, n, h, i in brute(docs, items)}
    found = QUERIES["op1_decontaminate"](spark, small)
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == want
    for name in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    result = duckdb.sql(SQL["op1_decontaminate"])
    assert result.columns == found.columns
    assert {r[0]: r[1:] for r in result.fetchall()} == want
    assert any(v[4] for v in want.values())


def test_removal(spark):
    docs = spark.createDataFrame([(*r, "kept") for r in DOCS] + [(None, "solo", "z"), (9, "clean\n text", "c")], "doc_id long, text string, id string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = decontaminate.remove_documents(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 6, 7, 9]
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, items).collect()}
    assert cut[1] == "x " + " " * 14 + " y" and cut[2] == "  ,   ! " and cut[3] is None and cut[9] == "clean\n text"


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, "solo"), (1, "solo"), (1, "other")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert got(decontaminate.hits(docs, items)) == [(1, 1, 0, []), (1, 1, 1, ["3"])]
    assert got(decontaminate.hits(docs, items.limit(0))) == [(1, 1, 0, []), (1, 1, 0, [])]
    assert decontaminate.hits(docs.limit(0), items).count() == 0
