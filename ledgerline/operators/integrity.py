"""Integrity checks over stored blocks and transactions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.operators.ordered import bucket_of, explode_range, neighbours
from ledgerline.operators.scans import in_range, segment_gaps
from ledgerline.session import shared_folder


def block_histogram(
    df: DataFrame, column: str, interval: int, lo: int | None = None, hi: int | None = None
) -> DataFrame:
    """Rows, lowest and highest number per interval; empty intervals are kept.

    ``complete`` says that the rows fill the span between both exactly. Only the
    empty runs between filled buckets are generated, from the runs' own edges.
    """
    filled = (
        in_range(df, column, lo, hi)
        .groupBy(bucket_of(F.col(column), interval).alias("slot"))
        .agg(
            F.count(column).alias("n"),
            F.min(column).alias("lo"),
            F.max(column).alias("hi"),
        )
    )
    linked = neighbours(filled.select("slot"), "slot", {"next_slot": "slot"}, after=True, levels=1)
    empty = explode_range(
        linked.where(F.col("next_slot") - F.col("slot") > 1),
        F.col("slot") + 1,
        F.col("next_slot") - 1,
        "missing",
    ).select(
        F.col("missing").alias("slot"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(None).cast("bigint").alias("lo"),
        F.lit(None).cast("bigint").alias("hi"),
    )
    complete = F.coalesce(F.col("n") == F.col("hi") - F.col("lo") + 1, F.lit(False))
    return filled.unionByName(empty).select(
        (F.col("slot") * interval).alias("bucket"), "n", "lo", "hi", complete.alias("complete")
    )


def incomplete_buckets(df: DataFrame, column: str, interval: int) -> DataFrame:
    """Buckets whose count differs from their span: gaps or duplicates inside."""
    filled = df.groupBy((bucket_of(F.col(column), interval) * interval).alias("bucket")).agg(
        F.count(column).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")
    )
    return filled.where(F.col("n") != F.col("hi") - F.col("lo") + 1)


def duplicates(
    df: DataFrame,
    key: str | Sequence[str],
    lo: int | None = None,
    hi: int | None = None,
    range_column: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Keys that occur more than once, with their count; all of them unless limited."""
    keys = [key] if isinstance(key, str) else list(key)
    if range_column is not None:
        df = in_range(df, range_column, lo, hi)
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return found if limit is None else found.orderBy(F.desc("n"), *keys).limit(limit)


def duplicates_by_fingerprint(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The rows of ``duplicates`` where almost all keys occur once and are long.

    First only 8 bytes a key are shuffled and counted. Keys whose fingerprint occurs more than once, few but for true
    duplicates, are then found by a semi join with the stored fingerprints, which the engine broadcasts as long as their
    table is small, and counted. It scans the key columns twice and shuffles whole keys in proportion to the duplicates.
    """
    keys = [key] if isinstance(key, str) else list(key)
    mark = F.xxhash64(*keys)
    marks = df.select(mark.alias("_mark")).groupBy("_mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_mark")
    path = f"{shared_folder(df.sparkSession)}/marks-{uuid.uuid4().hex}"
    marks.write.parquet(path)
    suspects = df.sparkSession.read.schema(marks.schema).parquet(path)
    return duplicates(df.select(*keys, mark.alias("_mark")).join(suspects, "_mark", "left_semi"), keys)


def gaps(df: DataFrame, column: str, width: int = K.ORDER_BUCKET) -> DataFrame:
    """Every missing run of numbers between the lowest and the highest.

    Numbers are made distinct first (copies collapse before the shuffle), so one
    bucket of the ordered step holds at most ``width`` rows.
    """
    numbers = df.select(F.col(column).alias("last_before")).where(F.col(column).isNotNull()).distinct()
    step = neighbours(numbers, "last_before", {"first_after": "last_before"}, after=True, width=width)
    return step.where(F.col("first_after") - F.col("last_before") > 1).select(
        "last_before",
        (F.col("last_before") + 1).alias("first_missing"),
        "first_after",
        (F.col("first_after") - F.col("last_before") - 1).alias("missing"),
    )


def first_gap(df: DataFrame, column: str, width: int = K.ORDER_BUCKET) -> DataFrame:
    return gaps(df, column, width).orderBy("last_before").limit(1)


def number_delta_check(blocks: DataFrame, delta: int) -> DataFrame:
    """Blocks whose native and EVM number differ by anything but ``delta``."""
    found = F.col("block_num") - F.col("evm_block_num")
    return blocks.where(found != delta).select("block_num", "evm_block_num", found.alias("found_delta"))


def parent_link_breaks(blocks: DataFrame) -> DataFrame:
    """Blocks whose parent hash is not the hash of the stored block before them.

    Copies of a block are collapsed before the join, so a number that is stored very
    often joins once per distinct version.
    """
    children = blocks.where(F.col("evm_prev_hash") != "").select("block_num", "evm_prev_hash").distinct()
    parents = blocks.select(
        (F.col("block_num") + 1).alias("block_num"), F.col("evm_hash").alias("parent_hash")
    ).distinct()
    return children.join(parents, "block_num").where(F.col("evm_prev_hash") != F.col("parent_hash"))


def orphan_transactions(txs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Transactions of blocks that are not stored.

    Only block numbers are shuffled and compared, one per block and task; the rows
    of the few missing blocks are then picked out where they lie.
    """
    known = blocks.select(F.col("evm_block_num").alias("block"))
    missing = txs.select("block").distinct().join(known, "block", "left_anti")
    return txs.join(missing, "block", "left_semi")


def fork_neighbourhood_check(
    forks: DataFrame, blocks: DataFrame, width: int = K.FORK_CHECK_WIDTH
) -> DataFrame:
    """For each fork: do the links hold within ``width`` blocks of its last good one?

    A band join. Every fork touches at most three cells of ``2 * width`` numbers, so
    blocks meet forks by an equi join on the cell. Only blocks near a fork have their
    links checked, and only the broken links are joined back. Forks from the same
    block are one point until the very end.
    """
    cell = 2 * width
    points = forks.select("last_non_forked").distinct()
    low, high = F.col("last_non_forked") - width, F.col("last_non_forked") + width
    near = points.withColumn(
        "cell", F.explode(F.sequence(bucket_of(low, cell), bucket_of(high, cell)))
    )
    cells = near.select("cell").distinct()
    with_cell = blocks.select(
        "block_num", "evm_hash", "evm_prev_hash", bucket_of(F.col("block_num"), cell).alias("cell")
    )
    # The parent of a cell's first block lies in the cell before it.
    wanted = cells.union(cells.select(F.col("cell") - 1)).distinct()
    local = with_cell.join(wanted, "cell", "left_semi")
    breaks = parent_link_breaks(local).withColumn("cell", bucket_of(F.col("block_num"), cell))
    hits = (
        near.join(breaks, "cell")
        .where(F.col("block_num").between(low + 1, high))
        .groupBy("last_non_forked")
        .agg(
            F.count(F.lit(1)).alias("breaks"),
            F.min(F.struct("block_num", "evm_prev_hash", "parent_hash")).alias("first"),
        )
    )
    mismatch = F.concat(
        F.lit("Mismatch at block "),
        F.col("first.block_num").cast("string"),
        F.lit(": "),
        F.col("first.evm_prev_hash"),
        F.lit(" != "),
        F.col("first.parent_hash"),
    )
    return forks.join(hits, "last_non_forked", "left").select(
        "arrival_seq",
        "last_non_forked",
        F.col("breaks").isNull().alias("ok"),
        F.coalesce(F.col("breaks"), F.lit(0)).alias("breaks"),
        F.coalesce(mismatch, F.lit("All hashes follow the rule")).alias("message"),
    )


def integrity_report(
    blocks: DataFrame,
    txs: DataFrame,
    delta: int,
) -> DataFrame:
    """All checks as rows (check, key, detail). A clean data set gives no row.

    Each branch reads only its own columns.
    """

    def rows(df: DataFrame, check: str, key: str, *detail) -> DataFrame:
        return df.select(
            F.lit(check).alias("check"),
            F.col(key).cast("string").alias("key"),
            F.concat_ws(" ", *detail).alias("detail"),
        )

    parts = [
        rows(
            number_delta_check(blocks, delta),
            "number_delta",
            "block_num",
            F.lit("delta"),
            F.col("found_delta"),
        ),
        rows(duplicates(blocks, "evm_block_num"), "duplicate_block", "evm_block_num", F.lit("copies"), F.col("n")),
        rows(duplicates(txs, "hash"), "duplicate_tx", "hash", F.lit("copies"), F.col("n")),
        rows(segment_gaps(blocks), "missing_segment", "gap_start", F.lit("next"), F.col("gap_end")),
        rows(
            gaps(blocks, "evm_block_num"),
            "gap",
            "last_before",
            F.lit("missing"),
            F.col("missing"),
            F.lit("native"),
            F.col("last_before") + delta,
        ),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def require_clean(report: DataFrame) -> None:
    """Raise on the first finding of a report."""
    found = report.limit(1).collect()
    if found:
        raise ValueError(f"integrity check failed: {found[0].check} {found[0].key} {found[0].detail}")
