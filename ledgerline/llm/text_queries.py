"""Queries of the operators over documents, by their contracts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontaminate, langid, licenses, neardup, pii, secrets
from ledgerline.llm.common import read
from ledgerline.llm.registry import query


@query("op10_bpe")
def bpe_round_trip(spark, folder):
    """Every whole text encoded and decoded, by digests."""
    where = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = read(spark, folder, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, *where).drop("text"), *where)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_near_duplicates")
def near_duplicates(spark, folder):
    """Components of documents that share four fifths of their word pairs."""
    return neardup.near_duplicates(read(spark, folder, "documents").select("doc_id", "text"), k=2)


@query(
    "op1_decontaminate",
    r"""
WITH items AS (
  SELECT item_id, ws, least(len(ws), 13) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT *, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM items)),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
own AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT doc_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM docs, (SELECT DISTINCT k FROM windows))),
hits AS (SELECT o.doc_id, o.i, o.k, n.item_id FROM own o JOIN windows n ON o.k = n.k AND o.w = n.w),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS j FROM hits) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
""",
)
def decontaminated(spark, folder):
    """Benchmark windows in every whole text."""
    found = decontaminate.hits(
        read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "benchmark"), item_id="item_id"
    )
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated(5).alias("contaminated"),
    )


@query("op4_secrets")
def secret_spans(spark, folder):
    """Patterns and character models over every whole text; the models learn from labelled strings of the table."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(secrets.labelled_strings(docs)))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
    )


@query("op5_languages")
def languages(spark, folder):
    """Language of every whole text, learned from the labels of documents that aren't held out."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    apart = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~apart))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", apart.alias("held_out"), "lang_pred", "score")


@query("op2_surrogates")
def surrogates(spark, folder):
    """Every whole text with surrogates for the personal data in it."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = pii.replace(docs, key="corpus")
    total = F.aggregate(F.map_values("kinds"), F.lit(0), lambda s, n: s + n)
    return found.select("doc_id", "text", total.cast("long").alias("n_entities"))


@query("op9_licenses")
def license_scan(spark, folder):
    """License of every document. The table has no paths: a document lies in the directory of its source, a hundred
    thousand ids, a thousand and fifty; a document whose id ends its fifty is that directory's licence file."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "source")
    cut = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    path = F.concat_ws("/", "source", cut(100_000), cut(1_000), cut(50), F.col("doc_id").cast("string"))
    found = licenses.scan(docs.select(path.alias("path"), "text", (F.col("doc_id") % 50 == 49).alias("is_license")))
    doc = lambda p: F.substring_index(p, "/", -1).cast("long")
    return found.select(
        doc(F.col("path")).alias("doc_id"), "path", "license", F.round("score", 6).alias("score"), "origin", doc(F.col("holder")).alias("holder_id")
    )
