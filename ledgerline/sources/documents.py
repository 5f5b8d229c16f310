"""JSON documents of blocks and transactions: reading, flattening, writing back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline import schemas as S
from ledgerline.functions.text import segment_of

# Document field -> column, where the names differ.
RAW_NAMES = {"value": "value_hex", "logsBloom": "logs_bloom"}

BLOCK_NAMES = {
    "@blockHash": "native_hash",
    "@evmBlockHash": "evm_hash",
    "@evmPrevBlockHash": "evm_prev_hash",
    "@receiptsRootHash": "receipts_root",
    "@transactionsRoot": "transactions_root",
    "gasUsed": "gas_used",
    "gasLimit": "gas_limit",
    "size": "size",
}


def read_documents(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Lines of JSON as flat text columns, ready for the validators."""
    schema = S.TRANSACTION_DOCUMENT if kind == "transaction" else S.BLOCK_DOCUMENT
    return flatten_documents(spark.read.schema(schema).json(path), kind)


def flatten_documents(docs: DataFrame, kind: str) -> DataFrame:
    if kind == "transaction":
        fields = S.TRANSACTION_DOCUMENT["@raw"].dataType.names
        return docs.select(
            F.col("`@timestamp`").alias("ts"),
            "trx_id",
            "action_ordinal",
            *[F.col("`@raw`")[name].alias(RAW_NAMES.get(name, name)) for name in fields],
        )
    return docs.select(
        "block_num",
        F.col("`@global`.block_num").alias("evm_block_num"),
        F.col("`@timestamp`").alias("ts"),
        *[F.col(f"`{name}`").alias(column) for name, column in BLOCK_NAMES.items()],
    )


def typed_transactions(flat: DataFrame, delta: int, per_segment: int = K.BLOCKS_PER_SEGMENT) -> DataFrame:
    """Flat text columns to the table schema; what does not fit its type is NULL."""
    numbered = flat.withColumns(
        {
            "block_num": F.col("block") + delta,
            "segment": segment_of(F.col("block") + delta, per_segment),
        }
    )
    return _cast(numbered, S.TRANSACTIONS)


def typed_blocks(flat: DataFrame, per_segment: int = K.BLOCKS_PER_SEGMENT) -> DataFrame:
    filled = flat.withColumns(
        {
            "logs_bloom": F.lit(None).cast("string"),
            "tx_count": F.lit(None).cast("bigint"),
            "segment": segment_of(F.col("block_num"), per_segment),
        }
    )
    return _cast(filled, S.BLOCKS)


def _cast(df: DataFrame, schema) -> DataFrame:
    have = dict(df.dtypes)
    return df.select(
        *[
            (
                F.col(field.name)
                if have[field.name] == field.dataType.simpleString()
                else F.col(field.name).cast(field.dataType)
                if have[field.name].startswith("array")
                else F.col(field.name).try_cast(field.dataType)
            ).alias(field.name)
            for field in schema
        ]
    )


def document(kind: str) -> Column:
    """The document of a table row."""
    if kind == "transaction":
        columns = {RAW_NAMES.get(name, name): name for name in S.TRANSACTION_DOCUMENT["@raw"].dataType.names}
        typed = {f.name: f.dataType for f in S.TRANSACTION_DOCUMENT["@raw"].dataType}
        raw = F.struct(
            *[F.col(column).cast(typed[name]).alias(name) for column, name in columns.items()]
        )
        return F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("@timestamp"),
            "trx_id",
            "action_ordinal",
            F.array().cast("array<string>").alias("signatures"),
            raw.alias("@raw"),
        )
    return F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("@timestamp"),
        "block_num",
        F.struct(F.col("evm_block_num").alias("block_num")).alias("@global"),
        *[F.col(column).cast("string").alias(name) for name, column in BLOCK_NAMES.items()],
    )


def to_documents(table: DataFrame, kind: str) -> DataFrame:
    """Table rows back to the document shape, one JSON text per row."""
    return table.select(F.to_json(document(kind)).alias("document"))
