"""Per-block totals, indices and running gas; block assembly and reindexing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.operators.bloom import EMPTY_BLOOM, bloom_union, with_words
from ledgerline.operators.ordered import bucket_of, running_totals
from ledgerline.operators.scans import in_range, with_segment


HEADER = ("block_num", "ts", "native_hash")
CARRIED = ("evm_hash", "evm_prev_hash", "receipts_root", "transactions_root")


def with_tx_index(
    actions: DataFrame,
    by: str = "block_num",
    position: str = "action_seq",
    width: int = K.BLOCK_PART,
    several: DataFrame | None = None,
) -> DataFrame:
    """``trx_index``: 0-based rank of an accepted action in its block.

    ``position`` is the action's unique place among all actions of its block; blocks of more
    than ``width`` actions are ranked in parts. ``several`` as for ``running_totals``.
    """
    spread = bucket_of(F.col(position).cast("bigint"), width)
    ranked = running_totals(actions, by, [position], spread, {"trx_index": F.lit(1).cast("bigint")}, several=several)
    return ranked.withColumn("trx_index", F.col("trx_index") - 1)


def with_running_gas(
    txs: DataFrame, by: str = "block", gas: str = "gasused", width: int = K.BLOCK_PART, several: DataFrame | None = None
) -> DataFrame:
    """``gasusedblock``: gas of the block up to and including the transaction."""
    spread = bucket_of(F.col("trx_index").cast("bigint"), width)
    totals = running_totals(txs, by, ["trx_index"], spread, {"gasusedblock": F.col(gas)}, several=several)
    return totals.withColumn("gasusedblock", F.col("gasusedblock").cast(txs.schema[gas].dataType))


def tx_totals(
    txs: DataFrame, by: str = "block", size: Column | None = None, bloom: bool = False
) -> DataFrame:
    """Gas, size and count per block that has transactions, and its bloom if wanted."""
    return (with_words(txs) if bloom else txs).groupBy(by).agg(
        F.sum("gasused").alias("gas_used"),
        F.sum(F.lit(0) if size is None else size).cast("bigint").alias("size"),
        F.count(F.lit(1)).alias("tx_count"),
        *([bloom_union().alias("logs_bloom")] if bloom else []),
    )


def block_totals(blocks: DataFrame, txs: DataFrame, size: Column | None = None) -> DataFrame:
    """Totals for every block, zero for those without transactions.

    Transactions are summed first, so the join meets one row per block on each side.
    """
    totals = tx_totals(txs, "block", size).withColumnRenamed("block", "evm_block_num")
    zero = F.lit(0)
    numbers = blocks.select("block_num", "evm_block_num")
    return numbers.join(totals, "evm_block_num", "left").select(
        "block_num",
        "evm_block_num",
        F.coalesce("gas_used", zero).alias("gas_used"),
        F.coalesce("size", zero).alias("size"),
        F.coalesce("tx_count", zero).alias("tx_count"),
    )


def assemble_blocks(
    headers: DataFrame,
    txs: DataFrame,
    delta: int,
    size: Column | None = None,
    per_segment: int = K.BLOCKS_PER_SEGMENT,
) -> DataFrame:
    """Block records from native headers and translated transactions.

    Hashes and roots are carried over from the headers where they have them.
    """
    kept = [name for name in (*HEADER, *CARRIED) if name in headers.columns]
    numbered = headers.select(*kept, (F.col("block_num") - delta).alias("evm_block_num"))
    totals = tx_totals(txs, "block", size, bloom=True).withColumnRenamed("block", "evm_block_num")
    joined = numbered.join(totals, "evm_block_num", "left")

    def carried(name: str, default) -> Column:
        value = F.col(name) if name in headers.columns else F.lit(None)
        return F.coalesce(value, F.lit(default)).alias(name)

    record = joined.select(
        "block_num",
        "evm_block_num",
        F.date_trunc("second", "ts").alias("ts"),
        F.lower("native_hash").alias("native_hash"),
        carried("evm_hash", ""),
        carried("evm_prev_hash", ""),
        carried("receipts_root", K.EMPTY_ROOT),
        carried("transactions_root", K.EMPTY_ROOT),
        F.coalesce(F.col("gas_used"), F.lit(0)).cast("decimal(38,0)").alias("gas_used"),
        F.lit(K.BLOCK_GAS_LIMIT).cast("decimal(38,0)").alias("gas_limit"),
        F.coalesce(F.col("size"), F.lit(0)).cast("bigint").alias("size"),
        F.coalesce(F.col("logs_bloom"), F.lit(EMPTY_BLOOM)).alias("logs_bloom"),
        F.coalesce(F.col("tx_count"), F.lit(0)).alias("tx_count"),
    )
    return with_segment(record, "block_num", per_segment)


def genesis_block(headers: DataFrame, delta: int, per_segment: int = K.BLOCKS_PER_SEGMENT) -> DataFrame:
    """Skeleton record of the block before the first: no gas, no roots, zero parent."""
    return with_segment(
        headers.select(
            "block_num",
            (F.col("block_num") - delta).alias("evm_block_num"),
            "ts",
            F.lower("native_hash").alias("native_hash"),
            "evm_hash",
            F.lit(K.ZERO_HASH[2:]).alias("evm_prev_hash"),
            F.lit(K.EMPTY_ROOT).alias("receipts_root"),
            F.lit(K.EMPTY_ROOT).alias("transactions_root"),
            F.lit(0).cast("decimal(38,0)").alias("gas_used"),
            F.lit(K.BLOCK_GAS_LIMIT).cast("decimal(38,0)").alias("gas_limit"),
            F.lit(0).cast("bigint").alias("size"),
            F.lit("").alias("logs_bloom"),
            F.lit(0).cast("bigint").alias("tx_count"),
        ),
        "block_num",
        per_segment,
    )


def reindex_blocks(
    blocks: DataFrame,
    txs: DataFrame,
    delta: int,
    lo: int | None = None,
    hi: int | None = None,
    per_segment: int = K.BLOCKS_PER_SEGMENT,
) -> tuple[DataFrame, DataFrame]:
    """A range of blocks and their transactions, with number, gas, bloom and count
    computed anew. Hashes, roots and sizes are carried and linked.
    """
    hi = hi if hi and hi > 0 else None
    wanted = in_range(blocks, "block_num", lo, hi, per_segment)
    ranged = in_range(
        txs,
        "block",
        None if lo is None else lo - delta,
        None if hi is None else hi - delta,
        per_segment,
        shift=delta,
    )

    source = wanted.select(
        "block_num",
        (F.col("block_num") - delta).alias("evm_block_num"),
        "ts",
        "native_hash",
        "evm_hash",
        "evm_prev_hash",
        F.coalesce(F.col("receipts_root"), F.lit(K.EMPTY_ROOT)).alias("receipts_root"),
        F.coalesce(F.col("transactions_root"), F.lit(K.EMPTY_ROOT)).alias("transactions_root"),
        "size",
    )
    totals = tx_totals(ranged, "block", bloom=True).select(
        F.col("block").alias("evm_block_num"), "gas_used", "tx_count", "logs_bloom"
    )
    new_blocks = (
        source.join(totals, "evm_block_num", "left")
        .select(
            *[name for name in source.columns if name != "size"],
            F.coalesce(F.col("gas_used"), F.lit(0)).cast("decimal(38,0)").alias("gas_used"),
            F.lit(K.BLOCK_GAS_LIMIT).cast("decimal(38,0)").alias("gas_limit"),
            "size",
            F.coalesce(F.col("logs_bloom"), F.lit(EMPTY_BLOOM)).alias("logs_bloom"),
            F.coalesce(F.col("tx_count"), F.lit(0)).alias("tx_count"),
        )
    )
    hashes = source.select(
        F.col("evm_block_num").alias("block"), F.col("evm_hash").alias("_block_hash")
    )
    new_txs = (
        ranged.join(hashes, "block", "left")
        .where(F.col("_block_hash").isNotNull())
        .withColumn("block_hash", F.col("_block_hash"))
        .drop("_block_hash")
    )
    return with_segment(new_blocks, "block_num", per_segment), new_txs
