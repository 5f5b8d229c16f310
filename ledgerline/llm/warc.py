"""Web archives: writing pages as WARC records, and assembling captures from archives.

A page becomes a response (or a revisit, if a page of larger id has the same payload), a
request and a metadata record that point at it through ``WARC-Concurrent-To``. Records are
built as columns and written by the engine's own text writer, whose line end is the
record end; a file holds ``PAGES_PER_FILE`` pages at most. Archives are read file by file; a
record is cut out by its Content-Length, so payloads may hold anything.

A capture is a response or revisit with the records that are concurrent to it, either way
round, or concurrent to such a record. Records of no capture are left out.

Null payloads are empty, null addresses too. Rows that repeat page id and payload are one capture. Control
characters and spaces in addresses are percent-encoded. Empty tables give no archives and no captures.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import broadcast_if_small, staged
from ledgerline.llm.components import components

# Fixed values of the archive format.
VERSION = "WARC/1.0"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
CRLF = "\r\n"
RECORD_END = CRLF + CRLF

#: Shorter payloads are stored again instead of being referred to.
LEAST_SHARED = 1000
PAGES_PER_FILE = 1000
#: Groups of equal payloads (100 bytes each) sent to every executor; more are shuffled.
BROADCAST_GROUPS = 300_000

RECORD = (
    "record_id string, type string, uri string, date string, concurrent_to array<string>, refers_to string, "
    "digest string, fields map<string,string>, payload_bytes long, payload_sha1 string, payload binary"
)


def _id(role: str, page: Column, digest: Column) -> Column:
    raw = F.md5(F.concat_ws("|", F.lit(role), page.cast("string"), digest).cast("binary"))
    cuts = [F.substring(raw, *at) for at in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """One record without its end; headers whose value is null are left out."""
    lines = [F.lit(VERSION + CRLF)]
    for name, value in [*headers, ("Content-Length", F.octet_length(block).cast("string"))]:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")))
    return F.concat(*lines, F.lit(CRLF), block)


def write_pages(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Archives of ``pages`` below ``path``, compressed. Of equal payloads of ``LEAST_SHARED`` bytes or more the
    one of largest id is stored, the others refer to it."""
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page"), F.col(url).alias("url"), payload.alias("payload"))
    marked = rows.select("page", F.sha1(F.col("payload").cast("binary")).alias("digest"), F.octet_length("payload").alias("bytes"))
    groups = marked.where(F.col("bytes") >= LEAST_SHARED).groupBy("digest", "bytes").agg(F.max("page").alias("last"), F.count("*").alias("n"))
    groups = staged(groups.where("n > 1").select("digest", "bytes", "last"), "payload-groups")
    groups = broadcast_if_small(groups, BROADCAST_GROUPS)

    digested = rows.select("*", F.sha1(F.col("payload").cast("binary")).alias("digest"), F.octet_length("payload").alias("bytes"))
    digested = digested.join(groups, ["digest", "bytes"], "left")
    digested = digested.withColumn("url", _encoded(F.coalesce("url", F.lit(""))))
    page, digest = F.col("page"), F.col("digest")
    refers = F.when(F.col("last").isNotNull() & ~page.eqNullSafe(F.col("last")), _id("response", F.col("last"), digest))
    own = _id("response", page, digest)
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(RECORD_END),
    )
    common = [("WARC-Target-URI", F.col("url")), ("WARC-Date", date)]
    response = _record(
        [
            ("WARC-Type", F.when(refers.isNull(), F.lit("response")).otherwise(F.lit("revisit"))),
            ("WARC-Record-ID", own),
            *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
            ("WARC-Refers-To", refers),
            ("WARC-Profile", F.when(refers.isNotNull(), F.lit(PROFILE))),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        F.when(refers.isNull(), F.concat(head, F.col("payload"))).otherwise(head),
    )
    request = _record(
        [
            ("WARC-Type", "request"),
            ("WARC-Record-ID", _id("request", page, digest)),
            *common,
            ("WARC-Concurrent-To", own),
            ("Content-Type", "application/http; msgtype=request"),
        ],
        F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{RECORD_END}")),
    )
    metadata = _record(
        [
            ("WARC-Type", "metadata"),
            ("WARC-Record-ID", _id("metadata", page, digest)),
            *common,
            ("WARC-Concurrent-To", own),
            ("Content-Type", "application/warc-fields"),
        ],
        F.concat(F.lit("page-id: "), F.coalesce(page.cast("string"), F.lit("")), F.lit(CRLF)),
    )
    out = digested.select(F.concat_ws(RECORD_END, request, response, metadata).alias("value"))
    out.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", PAGES_PER_FILE).text(path)


def _encoded(url: Column) -> Column:
    """Percent-encoding of what would end or split a header line."""
    parts = F.regexp_extract_all(url, F.lit(r"[^\x00-\x20\x7F]+|[\x00-\x20\x7F]"), F.lit(0))
    code = lambda p: F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(p)), 2, "0"))
    odd = F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"\A[\x00-\x20\x7F]\z"), code(p)).otherwise(p)), "")
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), odd).otherwise(url)


def parse(stream):
    """``(headers, block)`` of every record of a binary stream, one at a time; header names in lower case."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers: list[tuple[str, str]] = []
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[0] in " \t" and headers:
                headers[-1] = headers[-1][0], f"{headers[-1][1]} {text.strip()}"
            else:
                name, _, value = text.partition(":")
                headers.append((name.strip().lower(), value.strip()))
        size = dict(headers).get("content-length")
        block = stream.read(int(size)) if size else b""
        if size is None or len(block) < int(size):
            raise ValueError("a record is cut short")
        yield headers, block


def _row(headers: list[tuple[str, str]], block: bytes, payload: bool) -> dict:
    own = dict(headers)
    kind = own.get("content-type", "").partition(";")[0].strip().lower()
    body = block.partition(b"\r\n\r\n")[2] if kind == "application/http" else block
    fields = []
    if kind == "application/warc-fields":
        lines = (line.partition(":") for line in body.decode("utf-8", "replace").splitlines() if line.strip())
        fields = list({name.strip().lower(): value.strip() for name, _, value in lines}.items())
    return {
        "record_id": own.get("warc-record-id"),
        "type": own.get("warc-type"),
        "uri": own.get("warc-target-uri"),
        "date": own.get("warc-date"),
        "concurrent_to": [value for name, value in headers if name == "warc-concurrent-to"],
        "refers_to": own.get("warc-refers-to"),
        "digest": own.get("warc-payload-digest"),
        "fields": fields,
        "payload_bytes": len(body),
        "payload_sha1": hashlib.sha1(body).hexdigest(),
        "payload": body if payload else None,
    }


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Every record of the archives below ``path``, compressed or not; without ``payload`` its bytes stay behind."""
    text = pa.string()
    schema = pa.schema(
        [
            ("record_id", text), ("type", text), ("uri", text), ("date", text), ("concurrent_to", pa.list_(text)),
            ("refers_to", text), ("digest", text), ("fields", pa.map_(text, text)), ("payload_bytes", pa.int64()),
            ("payload_sha1", text), ("payload", pa.binary()),
        ]
    )

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                raw = io.BytesIO(content.as_py())
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if raw.getbuffer()[:2] == b"\x1f\x8b" else raw
                held, size = [], 0
                for headers, block in parse(stream):
                    held.append(_row(headers, block, payload))
                    size += len(block) if payload else 300
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def _transactions(links: DataFrame, anchors: DataFrame) -> DataFrame:
    """``(record_id, transaction)``: the transaction of every record that a link leads to, over any number of hops.

    ``links(a, b)`` go both ways. Records beside a response or revisit are settled by one join; only links between
    different homes, which most archives lack, are followed further.
    """
    beside = links.join(anchors.select(F.col("record_id").alias("b")), "b", "left_semi").groupBy("a").agg(F.min("b").alias("home"))
    beside = beside.join(anchors.select(F.col("record_id").alias("a")), "a", "left_anti")
    homes = beside.unionByName(anchors.select(F.col("record_id").alias("a"), F.col("record_id").alias("home")))
    homes = staged(homes.withColumnRenamed("a", "record_id"), "homes")
    ends = links
    for end in ("a", "b"):
        ends = ends.join(homes.select(F.col("record_id").alias(end), F.col("home").alias(f"home_{end}")), end, "left")
    ends = ends.select(F.coalesce("home_a", "a").alias("a"), F.coalesce("home_b", "b").alias("b"))
    joined = components(ends.where("a <> b").distinct())
    nodes = homes.unionByName(links.select(F.col("a").alias("record_id")).distinct().join(homes, "record_id", "left_anti").withColumn("home", F.col("record_id")))
    nodes = nodes.join(joined.withColumnRenamed("node", "home"), "home", "left")
    return nodes.select("record_id", F.coalesce("component", "home").alias("transaction"))


def captures(records: DataFrame) -> DataFrame:
    """One row per capture: its ``response`` (or revisit), ``request`` (the first by id) and ``metadata`` records, nested.

    A transaction is all that concurrent-to links join, in whatever direction; where it holds several responses, each
    has its row with the same request and metadata. Records of a transaction without a response have none.
    """
    records = records.where("record_id is not null").dropDuplicates(["record_id"])
    known = staged(records.select("record_id", "type", "concurrent_to"), "records")
    ends = known.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b")).where("a <> b")
    links = ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    answers = "type in ('response', 'revisit')"
    owner = _transactions(links, known.where(answers).select("record_id"))
    anchors, others = records.where(answers), records.where("type not in ('response', 'revisit')")
    whole = F.struct(*records.columns)
    parts = others.select("record_id", "type", whole.alias("whole")).join(owner, "record_id")
    parts = parts.groupBy("transaction").agg(
        F.min_by(F.when(F.col("type") == "request", F.col("whole")), F.when(F.col("type") == "request", F.col("record_id"))).alias("request"),
        F.collect_list(F.when(F.col("type") == "metadata", F.col("whole"))).alias("metadata"),
    )
    joined = anchors.select("record_id", whole.alias("response")).join(owner, "record_id").join(parts, "transaction", "left")
    return joined.select(
        "response", "request", F.coalesce("metadata", F.array().cast(parts.schema["metadata"].dataType)).alias("metadata")
    )
