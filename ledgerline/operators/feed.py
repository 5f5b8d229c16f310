"""The message feed: one message per transaction, then one per block."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions.hexes import add_0x, long_to_hex, num_to_hex, packed, unpacked
from ledgerline.functions.text import epoch_seconds
from ledgerline.operators.ordered import bucket_of
from ledgerline.sources.documents import document

HEAD, RAW = "head", "raw"
#: Blocks that are shuffled together: a header follows its parent, so the link to it takes little room on disk.
TOGETHER = 64


def head_messages(blocks: DataFrame, txs: DataFrame | None = None, slices: int = 1) -> DataFrame:
    """Block headers. Gas is the running gas of the block's last transaction if the
    transactions are given, else the stored total, which is the same number.

    Headers are wide: with ``slices``, a task that reads many of them holds only those of one slice to shuffle them.
    """
    if txs is None:
        source = blocks.withColumn("_gas", F.col("gas_used"))
    else:
        last = txs.groupBy(F.col("block").alias("_block")).agg(F.max_by("gasusedblock", "trx_index").alias("_gas"))
        place = lambda number: bucket_of(F.col(number).cast("bigint"), TOGETHER)
        same = (F.col("_place") == F.col("_its_place")) & F.col("evm_block_num").between(F.col("_block"), F.col("_block"))
        last = last.withColumn("_its_place", place("_block"))
        hexes = ["native_hash", "evm_hash", "evm_prev_hash", "receipts_root", "transactions_root", "logs_bloom"]
        placed = packed(blocks, hexes).withColumn("_place", place("evm_block_num"))
        slice_of = lambda place: F.coalesce(F.pmod(F.col(place), F.lit(slices)), F.lit(0))
        joined = [
            placed.where(slice_of("_place") == n).join(last.where(slice_of("_its_place") == n), same, "left")
            for n in range(slices)
        ]
        source = unpacked(reduce(DataFrame.unionByName, joined), hexes)
    head = F.struct(
        F.lit("0x0").alias("difficulty"),
        add_0x(F.col("native_hash")).alias("extraData"),
        F.lit(K.BLOCK_GAS_LIMIT_HEX).alias("gasLimit"),
        F.lit(K.ZERO_ADDRESS).alias("miner"),
        F.lit("0x0000000000000000").alias("nonce"),
        add_0x(F.col("evm_prev_hash")).alias("parentHash"),
        add_0x(F.col("receipts_root")).alias("receiptsRoot"),
        F.lit(K.EMPTY_UNCLES).alias("sha3Uncles"),
        F.lit(K.EMPTY_ROOT).alias("stateRoot"),
        add_0x(F.col("transactions_root")).alias("transactionsRoot"),
        add_0x(F.col("evm_hash")).alias("hash"),
        num_to_hex(F.coalesce(F.col("_gas"), F.lit(0))).alias("gasUsed"),
        add_0x(F.col("logs_bloom")).alias("logsBloom"),
        long_to_hex(F.col("evm_block_num")).alias("number"),
        long_to_hex(epoch_seconds(F.col("ts"))).alias("timestamp"),
    )
    return source.select(
        F.lit(HEAD).alias("type"),
        F.col("evm_block_num").alias("block"),
        F.lit(None).cast("bigint").alias("trx_index"),
        F.to_json(F.struct(F.lit(HEAD).alias("type"), head.alias("data"))).alias("message"),
    )


def raw_messages(txs: DataFrame, documents: bool = False) -> DataFrame:
    """One message per transaction: all its columns, or with ``documents`` the document that is stored for it."""
    body = document("transaction") if documents else F.struct(*[F.col(name) for name in txs.columns if name != "segment"])
    return txs.select(
        F.lit(RAW).alias("type"),
        "block",
        F.col("trx_index").cast("bigint").alias("trx_index"),
        F.to_json(F.struct(F.lit(RAW).alias("type"), body.alias("data"))).alias("message"),
    )


def head_feed(blocks: DataFrame, txs: DataFrame, documents: bool = False, slices: int = 1) -> DataFrame:
    """All messages. ``documents`` asks for whole rows of the transaction table. Sort by ``block``, ``trx_index`` with NULL last to send them in order.
    ``slices`` as for ``head_messages``."""
    return raw_messages(txs, documents).unionByName(head_messages(blocks, txs, slices))


def in_sending_order(feed: DataFrame) -> DataFrame:
    return feed.orderBy("block", F.asc_nulls_last("trx_index"))
