"""Queries of the operators over whole tables as structures: manifest, conversations, embedding groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import conversations, cosinedup, merkle
from ledgerline.llm.common import read
from ledgerline.llm.registry import query

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@query("op11_merkle_manifest")
def merkle_manifest(spark, folder):
    """Every document in the manifest; half of them then lose their line ends and are held against their proofs."""
    docs = read(spark, folder, "documents").select(*FIELDS)
    leaf = merkle.leaf_digest(*[F.col(c) for c in FIELDS])
    bare = merkle.leaf_digest(*[F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in FIELDS])
    changed = (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0) & F.contains("text", F.lit("\n"))
    return merkle.manifest(docs, "doc_id", "source", leaf, F.when(changed, bare).otherwise(leaf))


@query(
    "op13_embedding_groups",
    """
WITH RECURSIVE sound AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a, sound b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON node = e.vec_id LEFT JOIN counts ON a = e.vec_id
""",
)
def embedding_groups(spark, folder):
    """Links at a cosine of 0.9 or more, whatever the labels."""
    return cosinedup.near_duplicates(read(spark, folder, "embeddings").select("vec_id", "embedding"))


@query("op12_conversation_repair")
def conversation_repair(spark, folder):
    """Every conversation damaged by the keys of its rows, then repaired at least cost."""
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    broken = conversations.damaged(rows, "conv_id", "turn", "role", "text")
    return conversations.repair(broken, rows.select(F.col("conv_id").alias("conv"))).withColumnRenamed("conv", "conv_id")
