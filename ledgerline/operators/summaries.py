"""Integrity from summaries of segments: what didn't change isn't read again.

A segment's summary says all that the checks need to know of it:

* ``runs``: the maximal runs of block numbers that are there,
* ``extra``: copies of a number beyond the first,
* ``delta``: blocks whose numbers don't fit,
* ``marks``: a 64-bit digest of each transaction hash, with its count.

Summaries of different segments combine by union, in any order, so only new or changed segments are summarised and the others'
are taken as they are. Runs that meet give no gap, runs that overlap give copies. Digests that occur twice, in one
segment or in several, point to the segments whose hashes are then compared in full, so the result is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.operators.integrity import duplicates, number_delta_check
from ledgerline.operators.ordered import bucket_of, explode_range, neighbours, running_totals
from ledgerline.operators.scans import segment_gaps

#: Tables of a summary, each with a ``segment``.
RUNS, EXTRA, DELTA, MARKS, SEGMENTS = "runs", "extra", "delta", "marks", "segments"


def runs(blocks: DataFrame, width: int = K.ORDER_BUCKET) -> DataFrame:
    """``(segment, lo, hi)`` of every maximal run of numbers inside a segment."""
    numbers = blocks.select("segment", F.col("evm_block_num").alias("n")).where("n is not null").distinct()
    near = neighbours(numbers, "n", {"_before": "n"}, by=["segment"], width=width)
    near = neighbours(near, "n", {"_after": "n"}, after=True, by=["segment"], width=width)
    begins = F.col("_before").isNull() | (F.col("_before") < F.col("n") - 1)
    ends = F.col("_after").isNull() | (F.col("_after") > F.col("n") + 1)
    edges = near.select("segment", "n", begins.alias("begins"), ends.alias("ends")).where("begins or ends")
    next_edge = F.lead("n").over(W.partitionBy("segment").orderBy("n"))
    edges = edges.withColumn("_next", next_edge).where("begins")
    return edges.select("segment", F.col("n").alias("lo"), F.when(F.col("ends"), F.col("n")).otherwise(F.col("_next")).alias("hi"))


def extra_copies(blocks: DataFrame) -> DataFrame:
    """``(segment, evm_block_num, more)``: copies of a number beyond the first; all rows without a number."""
    more = F.count(F.lit(1)) - F.when(F.col("evm_block_num").isNull(), 0).otherwise(1)
    return blocks.groupBy("segment", "evm_block_num").agg(more.alias("more")).where("more > 0")


def summarise(blocks: DataFrame, txs: DataFrame, delta: int) -> dict[str, DataFrame]:
    """Summaries of the segments of both tables."""
    wrong = number_delta_check(blocks, delta)
    apart = blocks.select("segment", "block_num", "evm_block_num").join(wrong.select("block_num", "evm_block_num").distinct(), ["block_num", "evm_block_num"], "left_semi")
    found = F.col("block_num") - F.col("evm_block_num")
    return {
        RUNS: runs(blocks),
        EXTRA: extra_copies(blocks),
        DELTA: apart.select("segment", "block_num", "evm_block_num", found.alias("found_delta")),
        MARKS: txs.groupBy("segment", F.xxhash64("hash").alias("mark")).agg(F.count(F.lit(1)).alias("n")),
        SEGMENTS: blocks.groupBy("segment").agg(F.count(F.lit(1)).alias("n")),
    }


def coverage(found: DataFrame, width: int = K.ORDER_BUCKET) -> DataFrame:
    """``(lo, hi, depth)``: how many runs cover each stretch between the first and the last number."""
    steps = found.select(F.explode(F.array(F.struct(F.col("lo").alias("at"), F.lit(1).alias("step")), F.struct((F.col("hi") + 1).alias("at"), F.lit(-1).alias("step")))).alias("s"))
    steps = steps.groupBy(F.col("s.at").alias("at")).agg(F.sum("s.step").alias("step")).withColumn("_all", F.lit(0))
    depth = running_totals(steps, "_all", ["at"], bucket_of(F.col("at"), width), {"depth": F.col("step")})
    depth = neighbours(depth.select("at", "depth"), "at", {"_next": "at"}, after=True, width=width)
    return depth.where("_next is not null").select(F.col("at").alias("lo"), (F.col("_next") - 1).alias("hi"), F.col("depth").cast("bigint").alias("depth"))


def suspects(marks: DataFrame) -> DataFrame:
    """``(segment, mark)`` of digests that more than one transaction has."""
    twice = marks.groupBy("mark").agg(F.sum("n").alias("n")).where("n > 1").select("mark")
    return marks.join(twice, "mark", "left_semi").select("segment", "mark")


def report(summary: dict[str, DataFrame], doubtful: DataFrame, delta: int) -> DataFrame:
    """The rows of ``integrity.integrity_report`` out of summaries.

    ``doubtful`` are transactions that hold, of every segment, all those with a digest among the ``suspects``.
    """
    stretches = coverage(summary[RUNS])
    deep = explode_range(stretches.where("depth > 1"), F.col("lo"), F.col("hi"), "evm_block_num").select("evm_block_num", "depth")
    more = summary[EXTRA].groupBy("evm_block_num").agg(F.sum("more").alias("more"))
    base = F.when(F.col("evm_block_num").isNull(), 0).otherwise(1)
    both = deep.withColumn("more", F.lit(0).cast("bigint")).unionByName(more.withColumn("depth", F.lit(None).cast("bigint")))
    copies = both.groupBy("evm_block_num").agg((F.coalesce(F.max("depth"), F.max(base)) + F.sum("more")).alias("n")).where("n > 1")
    open_ = stretches.where("depth = 0")

    def rows(df: DataFrame, check: str, key: str, *detail) -> DataFrame:
        return df.select(F.lit(check).alias("check"), F.col(key).cast("string").alias("key"), F.concat_ws(" ", *detail).alias("detail"))

    gaps = open_.select((F.col("lo") - 1).alias("last_before"), (F.col("hi") - F.col("lo") + 1).alias("missing"))
    parts = [
        rows(summary[DELTA], "number_delta", "block_num", F.lit("delta"), F.col("found_delta")),
        rows(copies, "duplicate_block", "evm_block_num", F.lit("copies"), F.col("n")),
        rows(duplicates(doubtful, "hash"), "duplicate_tx", "hash", F.lit("copies"), F.col("n")),
        rows(segment_gaps(summary[SEGMENTS]), "missing_segment", "gap_start", F.lit("next"), F.col("gap_end")),
        rows(gaps, "gap", "last_before", F.lit("missing"), F.col("missing"), F.lit("native"), F.col("last_before") + delta),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
