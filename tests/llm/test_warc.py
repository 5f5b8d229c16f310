"""Round trips through real archives, against brute force and the query's SQL."""

import glob
import gzip
import hashlib
import io

import duckdb
import pytest

from ledgerline.llm import data_queries, warc  # noqa: F401
from ledgerline.llm.registry import QUERIES, SQL

BIG = "é WARC/1.0\r\nWARC-Type: response\r\n\r\n" * 50
PAGES = [(1, "http://a/x y\r\nHost: z", BIG), (2, None, BIG), (3, "u", "short"), (4, "u", "short"), (5, "v", None), (6, "v", "\r\n\r\n"), (7, "w", "x" * 1000), (9, "w", "x" * 1000), (8, "w", "x" * 999)]


def round_trip(spark, pages, path):
    warc.write_pages(pages, path)
    rows = warc.captures(warc.read_records(spark, path)).collect()
    return {r.metadata[0]["fields"]["page-id"]: r for r in rows}, rows


def test_captures(spark, folder):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as last")
    got, rows = round_trip(spark, pages, f"{folder}/w")
    assert len(rows) == len(PAGES)
    for page, url, html in PAGES:
        r = got[str(page)]
        if page in (1, 7):
            assert r.response.type == "revisit" and r.response.payload_bytes == 0
            assert r.response.refers_to == got[{1: "2", 7: "9"}[page]].response.record_id
        else:
            assert r.response.type == "response" and bytes(r.response.payload).decode() == (html or "")
        assert r.response.digest == "sha1:" + hashlib.sha1((html or "").encode()).hexdigest()
        assert r.request.concurrent_to == [r.response.record_id] and r.request.type == "request"
        assert r.response.uri == ("http://a/x%20y%0D%0AHost:%20z" if page == 1 else url or "")
    raw = b"".join(gzip.open(f).read() for f in glob.glob(f"{folder}/w/*.gz"))
    assert len(list(warc.parse(io.BytesIO(raw)))) == 3 * len(PAGES)


def test_query_and_sql(spark, small):
    found = QUERIES["op8_warc"](spark, small)
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{small}/pages.parquet'")
    want = duckdb.sql(SQL["op8_warc"])
    assert found.columns == want.columns
    assert sorted(map(tuple, found.collect())) == sorted(want.fetchall())


def test_foreign_archives(spark, folder):
    """Uncompressed; the response points at the request, metadata at the request, one record belongs nowhere."""

    def record(kind, own, block, *more):
        lines = ["WARC/1.1", f"WARC-Type: {kind}", f"warc-record-id: {own}", *more, f"Content-Length: {len(block)}"]
        return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    data = record("warcinfo", "<i>", b"hello: x")
    data += record("request", "<q>", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http")
    data += record("response", "<r>", b"HTTP/1.1 200 OK\r\n\r\nbody", "Content-Type: application/http;", " msgtype=response", "WARC-Concurrent-To: <q>")
    data += record("metadata", "<m>", b"a: 1\r\nB: 2", "Content-Type: application/warc-fields", "WARC-Concurrent-To: <q>")
    with open(f"{folder}/x.warc", "wb") as file:
        file.write(data + data)  # repeated records count once
    (row,) = warc.captures(warc.read_records(spark, f"{folder}/x.warc")).collect()
    assert bytes(row.response.payload) == b"body" and row.request.record_id == "<q>"
    assert [m.fields for m in row.metadata] == [{"a": "1", "b": "2"}]
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(data[:-30])))


def test_records_any_number_of_hops_away(spark):
    """A request names a record that only a third one names, two responses share a request, a pair has no response."""
    links = {"r1": [], "q1": ["r1"], "m1": ["q1"], "m2": ["m1"], "q2": ["m3"], "r2": ["q2"], "m3": [], "m4": ["m3"], "q3": ["r3", "r4"], "r3": [], "r4": []}
    links |= {"q9": ["gone"], "m9": ["gone"], "r5": [], "m6": ["m6"]}
    kinds = {"r": "response", "q": "request", "m": "metadata"}
    rows = [(i, kinds[i[0]], to) for i, to in links.items()] * 2
    records = spark.createDataFrame(rows, "record_id string, type string, concurrent_to array<string>")
    got = {r.response.record_id: (r.request and r.request.record_id, sorted(m.record_id for m in r.metadata)) for r in warc.captures(records).collect()}
    assert got == {"r1": ("q1", ["m1", "m2"]), "r2": ("q2", ["m3", "m4"]), "r3": ("q3", []), "r4": ("q3", []), "r5": (None, [])}


def test_repeats_nulls_and_nothing(spark, folder):
    pages = spark.createDataFrame([(1, "u", "a"), (1, "u", "a"), (None, "u", BIG), (None, "u", BIG)], "page_id long, url string, html string")
    _, rows = round_trip(spark, pages, f"{folder}/w")
    assert sorted(r.metadata[0]["fields"]["page-id"] for r in rows) == ["", "1"]
    warc.write_pages(pages.limit(0), f"{folder}/none")
    assert warc.captures(warc.read_records(spark, f"{folder}/none")).count() == 0
