"""Range scans, lookups, bounds and segments over the block and transaction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions.text import segment_of
from ledgerline.operators.ordered import neighbours


def in_range(
    df: DataFrame,
    column: str,
    lo: int | None,
    hi: int | None,
    per_segment: int | None = None,
    shift: int = 0,
) -> DataFrame:
    """Rows with ``lo <= column <= hi``.

    Row groups are skipped by the range itself. With ``per_segment``, the size the
    table's ``segment`` is cut by, partitions are pruned from the file listing too.
    ``shift`` is what the column lacks to the native number that segments count.
    """
    parted = per_segment is not None and "segment" in df.columns
    low = (lo + shift) // per_segment if parted and lo is not None else None
    high = (hi + shift) // per_segment if parted and hi is not None else None
    if lo is not None:
        df = df.where(F.col(column) >= lo)
        df = df.where(F.col("segment") >= low) if parted else df
    if hi is not None:
        df = df.where(F.col(column) <= hi)
        df = df.where(F.col("segment") <= high) if parted else df
    return df


def bounded(
    df: DataFrame,
    start: int | None,
    stop: int | None = None,
    column: str = "block_num",
    per_segment: int | None = None,
) -> DataFrame:
    """Blocks before ``start`` are skipped; ``stop`` counts only when positive."""
    return in_range(df, column, start, stop if stop and stop > 0 else None, per_segment)


def block_range(
    blocks: DataFrame,
    lo: int | None = None,
    hi: int | None = None,
    fields: Sequence[str] | None = None,
    per_segment: int = K.BLOCKS_PER_SEGMENT,
) -> DataFrame:
    """Blocks of a native range in order, with only the columns asked for."""
    scan = in_range(blocks, "block_num", lo, hi, per_segment)
    if fields is not None:
        scan = scan.select(*dict.fromkeys(["block_num", *fields]))
    return scan.orderBy("block_num")


def tx_range(
    txs: DataFrame,
    lo: int | None = None,
    hi: int | None = None,
    delta: int = 0,
    per_segment: int = K.BLOCKS_PER_SEGMENT,
) -> DataFrame:
    """Transactions of a native block range, ordered by block and index.

    The bounds are native; the ``block`` column counts ``delta`` lower.
    """
    low = None if lo is None else lo - delta
    high = None if hi is None else hi - delta
    return in_range(txs, "block", low, high, per_segment, shift=delta).orderBy("block", "trx_index")


def block_at(blocks: DataFrame, number: int, per_segment: int = K.BLOCKS_PER_SEGMENT) -> DataFrame:
    """The block of that number: one row, or none unless there is exactly one."""
    found = in_range(blocks, "block_num", number, number, per_segment)
    # Two rows are enough to know that the number is ambiguous.
    counted = found.limit(2).groupBy("block_num").agg(F.count(F.lit(1)).alias("_copies"))
    unique = counted.where("_copies = 1").select("block_num")
    return found.join(F.broadcast(unique), "block_num", "left_semi")


def lookup_blocks(
    blocks: DataFrame, wanted: DataFrame, key: str = "block_num", fields: Sequence[str] = ("evm_hash",)
) -> DataFrame:
    """Exactly-one lookup of many numbers: status found, missing or ambiguous."""
    asked = wanted.select(key).distinct()
    met = blocks.join(asked.withColumnRenamed(key, "block_num"), "block_num", "left_semi")
    stored = met.groupBy(F.col("block_num").alias(key)).agg(
        F.count(F.lit(1)).alias("copies"), *[F.min(name).alias(name) for name in fields]
    )
    joined = asked.join(stored, key, "left")
    copies = F.coalesce(F.col("copies"), F.lit(0))
    status = F.when(copies == 1, "found").when(copies == 0, "missing").otherwise("ambiguous")
    return joined.select(
        key,
        status.alias("status"),
        *[F.when(copies == 1, F.col(name)).alias(name) for name in fields],
    )


def first_block(blocks: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """The lowest block. A top-1 per partition, then one merge: no full sort."""
    picked = blocks if fields is None else blocks.select(*fields)
    return picked.orderBy(F.asc("block_num")).limit(1)


def last_block(blocks: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    picked = blocks if fields is None else blocks.select(*fields)
    return picked.orderBy(F.desc("block_num")).limit(1)


def with_segment(
    df: DataFrame, column: Column | str = "block_num", per_segment: int = K.BLOCKS_PER_SEGMENT
) -> DataFrame:
    number = F.col(column) if isinstance(column, str) else column
    return df.withColumn("segment", segment_of(number, per_segment))


def segments(df: DataFrame) -> DataFrame:
    """Segments that hold rows, in order."""
    return df.select("segment").distinct().orderBy("segment")


def segments_in(df: DataFrame, lo: int, hi: int, per_segment: int = K.BLOCKS_PER_SEGMENT) -> DataFrame:
    """Segments that overlap a native block range, in order."""
    overlapping = F.col("segment").between(lo // per_segment, hi // per_segment)
    return df.where(overlapping).select("segment").distinct().orderBy("segment")


def segment_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


def batch_range(df: DataFrame, column: str = "block_num") -> DataFrame:
    """Lowest and highest number of a batch: the notice sent once it is written."""
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def segment_gaps(df: DataFrame) -> DataFrame:
    """Missing runs of whole segments: last one before and first one after."""
    present = df.select("segment").distinct()
    return (
        neighbours(present, "segment", {"gap_end": "segment"}, after=True, levels=1)
        .where(F.col("gap_end") - F.col("segment") > 1)
        .select(F.col("segment").alias("gap_start"), "gap_end")
    )
