"""Queries of the operators over archives, token files and vectors, by their contracts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ledgerline.llm import neighbours as neighbours_of
from ledgerline.llm import tokenfiles, warc
from ledgerline.llm.common import new_folder, read, staged
from ledgerline.llm.registry import query


@query(
    "op8_warc",
    """
WITH own AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS last FROM own)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN n < 1000 OR page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n < 1000 OR page_id = last THEN NULL ELSE last END AS refers_to
FROM marked
""",
)
def archives(spark, folder):
    """Every page written to archives, and what reading them gives back."""
    path = new_folder(spark, "archives")
    warc.write_pages(read(spark, folder, "pages"), path)
    records = staged(warc.read_records(spark, path, payload=False), "records")
    found = warc.captures(records)
    page = F.element_at(F.col("metadata")[0]["fields"], "page-id").try_cast("long")
    found = found.select(
        page.alias("page_id"), "response.record_id", "response.type", "response.refers_to", "response.payload_bytes", "response.payload_sha1"
    )
    found = staged(found, "captures")
    stored = found.where("type = 'response'")
    target = stored.select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("to"), F.col("payload_bytes").alias("n"), F.col("payload_sha1").alias("sha1")
    )
    again = found.where("type = 'revisit'").join(target, "refers_to", "left")
    columns = lambda n, sha1, to: ["page_id", n.alias("payload_bytes"), sha1.alias("payload_digest"), F.col("type").alias("record_type"), to.alias("refers_to")]
    return stored.select(*columns(F.col("payload_bytes"), F.col("payload_sha1"), F.lit(None).cast("long"))).unionByName(
        again.select(*columns(F.col("n"), F.col("sha1"), F.col("to")))
    )


@query("op3_neighbours")
def neighbours(spark, folder):
    """The 20 nearest of every twentieth vector among all others."""
    rows = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours_of.nearest(rows, rows.where("vec_id % 20 = 0"))


@query("op6_token_files")
def token_files(spark, folder):
    """Every document written as ids in order of its key, found again by the index and read back; those without a key by their place."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    path = new_folder(spark, "tokens")
    tokenfiles.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end=1)
    keys = docs.groupBy(F.col("doc_id").alias("key")).count()
    keys = keys.select("key", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("copy"))
    found = tokenfiles.lookup(spark, path, keys).drop("n")
    stored = tokenfiles.checksums(spark, path).join(tokenfiles.shard_starts(spark, path), ["part", "block"])
    both = found.join(stored.drop("key"), ["part", "block", "place"]).unionByName(stored.where("key is null"), allowMissingColumns=True)
    return both.select(
        F.col("key").alias("doc_id"), (F.col("begin") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc32").alias("ids_crc32")
    )
