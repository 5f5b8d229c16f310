"""Connected components of a graph too large for one machine.

Alternating large-star and small-star steps: every node sends its larger, then its smaller
neighbours to the least node it sees. Edges stay a table throughout; a node that a third of
all edges meet costs one row per map task in the aggregations, and its join is an ordinary
skewed join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)``; a component is its least node.

    Loops, nulls and repeated edges are ignored; no edges give no rows.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = staged(now, "edges")
    before = None
    while (mark := _fingerprint(now)) != before:
        before = mark
        now = staged(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _fingerprint(edges: DataFrame):
    both = F.xxhash64("a", "b").cast("decimal(20,0)")
    return edges.agg(F.count("*"), F.sum(both)).first()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
