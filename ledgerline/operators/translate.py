"""Translation of accepted actions to transactions, with error rows for bad ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline import schemas as S
from ledgerline.functions import codec
from ledgerline.functions import hexes as H
from ledgerline.functions import text as X
from ledgerline.operators.actions import (
    DEPOSIT,
    RAW,
    WITHDRAW,
    classify_actions,
    dedup_actions,
    in_several_parts,
    with_address,
)
from ledgerline.operators.totals import with_running_gas, with_tx_index


def receipt_text(console: Column) -> Column:
    """What a contract printed between the two receipt marks; NULL without both."""
    start = F.instr(console, K.RECEIPT_START)
    begin = start + len(K.RECEIPT_START)
    end = F.instr(console, K.RECEIPT_END)
    return F.when((start > 0) & (end >= begin), F.substr(console, begin, end - begin))


def parse_receipt(console: Column) -> Column:
    """The receipt as a struct; NULL when there is none or it is no valid JSON object."""
    parsed = F.from_json(
        receipt_text(console),
        S.RECEIPT,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    # as the element of an array it is parsed once for both
    return F.transform(F.array(parsed), lambda one: F.when(one["_corrupt"].isNull(), one))[0]


def worked_out(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Adds a costly column so that it is worked out once a row. As a mere column it would be copied into each place of a
    later filter that names it."""
    return df.withColumn(name, F.explode(F.array(column)))


def with_trimmed_itxs(itxs: Column) -> Column:
    """Sets ``input_trimmed`` of every inner transaction from its input."""
    return F.transform(
        itxs, lambda itx: itx.withField("input_trimmed", F.substring(itx["input"], 1, K.INPUT_TRIM))
    )


def odd_precision(actions: DataFrame) -> DataFrame:
    """Deposits and withdrawals whose amount does not have the four decimals that
    the scaling takes for granted."""
    asset = X.parse_asset(F.col("data.quantity"))
    return (
        actions.where(F.col("kind").isin(DEPOSIT, WITHDRAW))
        .withColumn("precision", asset["precision"])
        .where("precision <> 4")
        .select("block_num", "action_seq", "data.quantity", "precision")
    )


def translate(actions: DataFrame, accounts: DataFrame, delta: int) -> DataFrame:
    """Transaction columns and ``error`` for accepted, indexed actions.

    One pass over all kinds: the address join meets each row once, and both Arrow
    steps (decoding, hashing) see every row once, whatever its kind.
    """
    is_raw, is_deposit, is_withdraw = (F.col("kind") == kind for kind in (RAW, DEPOSIT, WITHDRAW))
    memo = F.coalesce(F.col("data.memo"), F.lit(""))

    looked_up = actions.withColumn(
        "_account",
        F.when(is_deposit & ~X.is_address(memo), F.col("data.from")).when(is_withdraw, F.col("data.to")),
    )
    resolved = with_address(looked_up, "_account", accounts)

    read = worked_out(resolved, "_receipt", F.when(is_raw, parse_receipt(F.col("console"))))
    parsed = read.withColumns(
        {
            "_asset": F.when(~is_raw, X.parse_asset(F.col("data.quantity"))),
            "_tx": codec.decode_legacy(F.when(is_raw, F.col("data.tx"))),
            "_sender": F.when(is_raw, H.add_0x(F.lower("data.sender"))),
        }
    )
    unsigned = ~F.coalesce(F.col("_tx.signed"), F.lit(False))
    native_target = X.deposit_target(memo, F.col("address"))
    native_from = F.concat(F.lit("0x"), F.lower(H.strip_0x(F.col("address"))))
    signer = (
        F.when(is_raw, F.col("_sender")).when(is_withdraw, F.col("address")).otherwise(F.lit(K.ZERO_ADDRESS))
    )
    wei = X.asset_to_wei(F.col("_asset.amount"))
    shaped = parsed.withColumns(
        {
            "_vrs": F.when(
                unsigned, H.synthetic_vrs(F.col("block_id"), signer, F.col("trx_index"))
            ).otherwise(F.struct(F.col("_tx.v").alias("v"), F.col("_tx.r").alias("r"), F.col("_tx.s").alias("s"))),
            "_wei": F.when(~is_raw & (wei >= 0), wei),
            "_to": F.when(is_raw, F.col("_tx.to"))
            .when(is_deposit, native_target)
            .otherwise(F.lit(K.ZERO_ADDRESS)),
            "_gas": H.hex_to_decimal(F.col("_receipt.gasused")),
            "_charged": H.hex_to_decimal(F.col("_receipt.charged_gas")),
        }
    ).withColumn("_value", F.when(is_raw, F.col("_tx.value_hex")).otherwise(H.decimal_to_hex(F.col("_wei"))))

    missing_account = F.concat(
        F.lit(K.ERR_NO_ACCOUNT),
        F.col("_account"),
        F.lit(", int: "),
        X.name_to_uint64(F.col("_account")).cast("string"),
    )
    no_address = F.col("address").isNull()
    error = (
        F.when(is_raw & (F.coalesce(F.length("console"), F.lit(0)) == 0), K.ERR_NO_CONSOLE)
        .when(
            is_raw
            & (
                F.col("_receipt").isNull()
                | F.col("_tx.error").isNotNull()
                | F.col("_tx.nonce").try_cast("decimal(20,0)").isNull()
                | F.col("_tx.gas_price").try_cast("decimal(38,0)").isNull()
                | F.col("_tx.gas_limit").try_cast("decimal(38,0)").isNull()
                | F.col("_gas").isNull()
                | F.col("_charged").isNull()
                | F.col("_receipt.createdaddr").isNull()
                | (unsigned & ~F.coalesce(X.is_address(F.col("_sender")), F.lit(False)))
            ),
            K.ERR_RAW,
        )
        .when(is_deposit & ~X.is_address(memo) & no_address & ~memo.startswith("0x"), K.ERR_UNREGISTERED)
        .when(is_deposit & ~X.is_address(memo) & no_address, K.ERR_BAD_TARGET)
        .when(is_withdraw & no_address, missing_account)
        .when(~is_raw & F.col("_asset").isNull(), K.ERR_BAD_ASSET)
        .when(~is_raw & F.col("_wei").isNull(), "amount out of range")
    )
    detail = (
        F.when(
            is_raw & unsigned & F.col("_tx.error").isNull() & F.col("_receipt").isNotNull(),
            F.concat(F.lit(K.ERR_BAD_ACCOUNT), F.coalesce(F.col("data.sender"), F.lit("")), F.lit("'")),
        )
        .when(is_raw & F.col("_receipt").isNull(), F.lit("receipt is no valid JSON"))
        .otherwise(F.col("_tx.error"))
    )
    checked = shaped.withColumns({"error": error, "error_detail": detail})

    price = F.when(is_raw, F.col("_tx.gas_price")).otherwise(F.lit(str(K.STANDARD_GAS_PRICE)))
    limit = F.when(is_raw, F.col("_tx.gas_limit")).otherwise(F.lit(str(K.STANDARD_GAS_LIMIT)))
    nonce = F.when(is_raw, F.col("_tx.nonce")).otherwise(F.lit("0"))
    data = F.when(is_raw, F.col("_tx.data")).otherwise(F.lit("0x"))
    digest = codec.legacy_digest(
        F.when(F.col("error").isNull(), nonce),
        price,
        limit,
        F.col("_to"),
        F.col("_value"),
        data,
        F.col("_vrs.v"),
        F.col("_vrs.r"),
        F.col("_vrs.s"),
    )
    logs = F.when(is_raw, X.empty_to_null(F.col("_receipt.logs")))
    hashed = checked.withColumns({"_digest": digest, "_logs": logs, "_bloom": codec.logs_bloom(logs)})

    receipt = F.col("_receipt")
    zero_text = F.lit("")
    return hashed.select(
        F.col("block_ts").alias("ts"),
        "trx_id",
        "action_ordinal",
        X.evm_number(F.col("block_num"), delta).alias("block"),
        "block_num",
        "trx_index",
        F.col("_digest.hash").alias("hash"),
        F.when(is_raw & ~unsigned, F.when(X.is_address(F.col("data.from")), F.lower("data.from")))
        .when(is_raw, F.col("_sender"))
        .when(is_withdraw, native_from)
        .otherwise(F.lit(K.ZERO_ADDRESS))
        .alias("from"),
        F.col("_to").alias("to"),
        zero_text.alias("block_hash"),
        data.alias("input_data"),
        F.when(is_raw, F.concat(F.lit("0x"), H.trim_input(H.strip_0x(data))))
        .otherwise(H.trim_input(data))
        .alias("input_trimmed"),
        F.col("_value").alias("value_hex"),
        F.when(is_raw, F.col("_tx.value_d")).otherwise(F.col("data.quantity")).alias("value_d"),
        nonce.try_cast("decimal(20,0)").alias("nonce"),
        price.try_cast("decimal(38,0)").alias("gas_price"),
        limit.try_cast("decimal(38,0)").alias("gas_limit"),
        F.when(is_raw, F.col("_gas"))
        .otherwise(F.lit(K.STANDARD_GAS_LIMIT).cast("decimal(38,0)"))
        .alias("gasused"),
        F.when(is_raw, F.col("_charged")).otherwise(F.lit(0).cast("decimal(38,0)")).alias("charged_gas_price"),
        F.when(is_raw, receipt["status"]).otherwise(F.lit(1)).cast("tinyint").alias("status"),
        F.when(is_raw, receipt["epoch"]).otherwise(F.lit(0)).cast("bigint").alias("epoch"),
        F.when(is_raw, F.lower(receipt["createdaddr"])).otherwise(zero_text).alias("createdaddr"),
        F.when(is_raw, receipt["output"]).otherwise(zero_text).alias("output"),
        F.when(is_raw, with_trimmed_itxs(receipt["itxs"]))
        .otherwise(F.array().cast(S.TRANSACTIONS["itxs"].dataType))
        .alias("itxs"),
        F.col("_logs").alias("logs"),
        F.col("_bloom").alias("logs_bloom"),
        F.when(is_raw, X.empty_to_null(receipt["errors"])).alias("errors"),
        F.col("_vrs.v").alias("v"),
        F.col("_vrs.r").alias("r"),
        F.col("_vrs.s").alias("s"),
        F.col("_digest.size").alias("raw_size"),
        "kind",
        "error",
        F.to_json(
            F.struct(
                F.col("block_id").alias("nativeBlockHash"),
                F.col("data").alias("tx"),
                X.evm_number(F.col("block_num"), delta).alias("block_num"),
                F.col("error_detail").alias("error"),
            )
        ).alias("error_info"),
        "action_seq",
    )


def split_errors(
    translated: DataFrame, fail_fast: bool = False, per_segment: int = K.BLOCKS_PER_SEGMENT
) -> tuple[DataFrame, DataFrame]:
    """(good transactions, error rows). ``fail_fast`` raises as soon as a bad row runs."""
    if fail_fast:
        guard = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error")).cast("string"))
        return (
            translated.withColumn("error", guard).where(F.col("error").isNull()).drop("error", "error_info"),
            translated.where(F.lit(False)).transform(_error_rows, per_segment),
        )
    good = translated.where(F.col("error").isNull()).drop("error", "error_info")
    return good, translated.where(F.col("error").isNotNull()).transform(_error_rows, per_segment)


def _error_rows(translated: DataFrame, per_segment: int) -> DataFrame:
    return translated.select(
        "ts",
        F.col("error").alias("message"),
        F.col("error_info").alias("info"),
        F.lit(None).cast("string").alias("stack"),
        "block_num",
        "action_seq",
        X.segment_of(F.col("block_num"), per_segment).alias("segment"),
    )


def deposits(actions: DataFrame, accounts: DataFrame, delta: int, fail_fast: bool = False):
    """Indexed deposit actions to (transactions, errors)."""
    return split_errors(translate(actions.where(F.col("kind") == DEPOSIT), accounts, delta), fail_fast)


def withdrawals(actions: DataFrame, accounts: DataFrame, delta: int, fail_fast: bool = False):
    return split_errors(translate(actions.where(F.col("kind") == WITHDRAW), accounts, delta), fail_fast)


def raw_transactions(actions: DataFrame, accounts: DataFrame, delta: int, fail_fast: bool = False):
    return split_errors(translate(actions.where(F.col("kind") == RAW), accounts, delta), fail_fast)


def accepted(actions: DataFrame, exclude_senders=(), width: int = K.BLOCK_PART) -> DataFrame:
    """Filtered, first copies only, and with their index in the block."""
    kept = classify_actions(actions, exclude_senders)
    return _indexed(kept, in_several_parts(kept, width), width)


def _indexed(kept: DataFrame, cut: DataFrame, width: int) -> DataFrame:
    return with_tx_index(dedup_actions(kept), width=width, several=dedup_actions(cut))


def translate_actions(
    actions: DataFrame,
    accounts: DataFrame,
    delta: int,
    exclude_senders=(),
    fail_fast: bool = False,
    per_segment: int = K.BLOCKS_PER_SEGMENT,
    width: int = K.BLOCK_PART,
) -> tuple[DataFrame, DataFrame]:
    """The whole way from native actions to (transactions with running gas, errors)."""
    kept = classify_actions(actions, exclude_senders)
    cut = in_several_parts(kept, width)
    good, bad = split_errors(translate(_indexed(kept, cut, width), accounts, delta), fail_fast, per_segment)
    several, _ = split_errors(translate(_indexed(cut, cut, width), accounts, delta), fail_fast, per_segment)
    txs = with_running_gas(good, width=width, several=several)
    return txs.withColumn("segment", X.segment_of(F.col("block_num"), per_segment)), bad


def tx_hash_audit(txs: DataFrame) -> DataFrame:
    """Stored and recomputed hash of each transaction, side by side."""
    recomputed = codec.legacy_hash(
        F.col("nonce"),
        F.col("gas_price"),
        F.col("gas_limit"),
        F.col("to"),
        F.col("value_hex"),
        F.col("input_data"),
        F.col("v"),
        F.col("r"),
        F.col("s"),
    )
    return txs.withColumn("recomputed", recomputed).select(
        "block", "trx_index", "hash", "recomputed", F.col("hash").eqNullSafe(F.col("recomputed")).alias("ok")
    )


def decode_raw(df: DataFrame, column: str = "tx") -> DataFrame:
    """Adds the decoded fields of a serialized transaction column, and ``error``."""
    return df.withColumn("_decoded", codec.decode_legacy(F.col(column))).select(*df.columns, "_decoded.*")
