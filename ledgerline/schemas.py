"""Table schemas, and the schemas of the JSON documents they are loaded from."""

from __future__ import annotations

from pyspark.sql import types as T

WIDE = T.DecimalType(38, 0)
NONCE = T.DecimalType(20, 0)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


LOG = _struct(address=T.StringType(), topics=T.ArrayType(T.StringType()), data=T.StringType())

INNER_TRANSACTION = _struct(
    callType=T.StringType(),
    gas=T.StringType(),
    input=T.StringType(),
    input_trimmed=T.StringType(),
    to=T.StringType(),
    value=T.StringType(),
    gasUsed=T.StringType(),
    output=T.StringType(),
    subtraces=T.StringType(),
    traceAddress=T.ArrayType(T.IntegerType()),
    type=T.StringType(),
    depth=T.StringType(),
    extra=T.StringType(),
).add("from", T.StringType())

BLOCKS = _struct(
    block_num=T.LongType(),
    evm_block_num=T.LongType(),
    ts=T.TimestampType(),
    native_hash=T.StringType(),
    evm_hash=T.StringType(),
    evm_prev_hash=T.StringType(),
    receipts_root=T.StringType(),
    transactions_root=T.StringType(),
    gas_used=WIDE,
    gas_limit=WIDE,
    size=T.LongType(),
    logs_bloom=T.StringType(),
    tx_count=T.LongType(),
    segment=T.LongType(),
)

TRANSACTIONS = T.StructType(
    [
        T.StructField(name, kind, True)
        for name, kind in [
            ("ts", T.TimestampType()),
            ("trx_id", T.StringType()),
            ("action_ordinal", T.LongType()),
            ("block", T.LongType()),
            ("block_num", T.LongType()),
            ("trx_index", T.LongType()),
            ("hash", T.StringType()),
            ("from", T.StringType()),
            ("to", T.StringType()),
            ("block_hash", T.StringType()),
            ("input_data", T.StringType()),
            ("input_trimmed", T.StringType()),
            ("value_hex", T.StringType()),
            ("value_d", T.StringType()),
            ("nonce", NONCE),
            ("gas_price", WIDE),
            ("gas_limit", WIDE),
            ("gasused", WIDE),
            ("gasusedblock", WIDE),
            ("charged_gas_price", WIDE),
            ("status", T.ByteType()),
            ("epoch", T.LongType()),
            ("createdaddr", T.StringType()),
            ("output", T.StringType()),
            ("itxs", T.ArrayType(INNER_TRANSACTION)),
            ("logs", T.ArrayType(LOG)),
            ("logs_bloom", T.StringType()),
            ("errors", T.ArrayType(T.StringType())),
            ("v", T.StringType()),
            ("r", T.StringType()),
            ("s", T.StringType()),
            ("segment", T.LongType()),
        ]
    ]
)

ERRORS = _struct(
    ts=T.TimestampType(),
    message=T.StringType(),
    info=T.StringType(),
    stack=T.StringType(),
    block_num=T.LongType(),
    action_seq=T.LongType(),
    segment=T.LongType(),
)

FORKS = _struct(
    ts=T.TimestampType(),
    last_non_forked=T.LongType(),
    last_forked=T.LongType(),
    arrival_seq=T.LongType(),
)

ACCOUNTS = _struct(account=T.StringType(), address=T.StringType(), idx=T.LongType())

# ``arrival_seq`` counts block arrivals: a block that is sent again after a fork has a
# new one. ``action_seq`` is the position of the action in its block, counted from 0.
ACTIONS = T.StructType(
    [
        T.StructField(name, kind, True)
        for name, kind in [
            ("arrival_seq", T.LongType()),
            ("block_num", T.LongType()),
            ("block_id", T.StringType()),
            ("block_ts", T.TimestampType()),
            ("action_seq", T.LongType()),
            ("account", T.StringType()),
            ("name", T.StringType()),
            ("receiver", T.StringType()),
            ("act_digest", T.StringType()),
            ("trx_id", T.StringType()),
            ("action_ordinal", T.LongType()),
            ("console", T.StringType()),
            (
                "data",
                T.StructType(
                    [
                        T.StructField(name, T.StringType(), True)
                        for name in ("from", "to", "quantity", "memo", "tx", "sender")
                    ]
                ),
            ),
        ]
    ]
)

# The receipt JSON a contract prints for a raw transaction.
RECEIPT = _struct(
    status=T.IntegerType(),
    epoch=T.LongType(),
    itxs=T.ArrayType(INNER_TRANSACTION),
    logs=T.ArrayType(LOG),
    errors=T.ArrayType(T.StringType()),
    output=T.StringType(),
    gasused=T.StringType(),
    gasusedblock=T.StringType(),
    charged_gas=T.StringType(),
    createdaddr=T.StringType(),
    _corrupt=T.StringType(),
)

# JSON documents as they lie in dumps: numbers that may exceed 64 bits are text.
TRANSACTION_DOCUMENT = T.StructType(
    [
        T.StructField("@timestamp", T.StringType()),
        T.StructField("trx_id", T.StringType()),
        T.StructField("action_ordinal", T.LongType()),
        T.StructField("signatures", T.ArrayType(T.StringType())),
        T.StructField(
            "@raw",
            T.StructType(
                [
                    T.StructField(name, kind)
                    for name, kind in [
                        ("hash", T.StringType()),
                        ("from", T.StringType()),
                        ("trx_index", T.LongType()),
                        ("block", T.LongType()),
                        ("block_hash", T.StringType()),
                        ("to", T.StringType()),
                        ("input_data", T.StringType()),
                        ("input_trimmed", T.StringType()),
                        ("value", T.StringType()),
                        ("value_d", T.StringType()),
                        ("nonce", T.StringType()),
                        ("gas_price", T.StringType()),
                        ("gas_limit", T.StringType()),
                        ("status", T.LongType()),
                        ("itxs", T.ArrayType(INNER_TRANSACTION)),
                        ("epoch", T.LongType()),
                        ("createdaddr", T.StringType()),
                        ("gasused", T.StringType()),
                        ("gasusedblock", T.StringType()),
                        ("charged_gas_price", T.StringType()),
                        ("output", T.StringType()),
                        ("logs", T.ArrayType(LOG)),
                        ("logsBloom", T.StringType()),
                        ("errors", T.ArrayType(T.StringType())),
                        ("v", T.StringType()),
                        ("r", T.StringType()),
                        ("s", T.StringType()),
                    ]
                ]
            ),
        ),
    ]
)

BLOCK_DOCUMENT = T.StructType(
    [
        T.StructField("@timestamp", T.StringType()),
        T.StructField("block_num", T.LongType()),
        T.StructField("@global", T.StructType([T.StructField("block_num", T.LongType())])),
        T.StructField("@blockHash", T.StringType()),
        T.StructField("@evmBlockHash", T.StringType()),
        T.StructField("@evmPrevBlockHash", T.StringType()),
        T.StructField("@receiptsRootHash", T.StringType()),
        T.StructField("@transactionsRoot", T.StringType()),
        T.StructField("gasUsed", T.StringType()),
        T.StructField("gasLimit", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("table", T.StringType()),
    ]
)
