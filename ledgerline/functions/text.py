"""Assets, account names, validity checks and time, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions.hexes import strip_0x

ASSET_PATTERN = r"(?s)^\s*(-?)(\d+)(?:\.(\d*))?(.*)$"


def parse_asset(text: Column) -> Column:
    """``"12.3400 ABC"`` to (amount digits, precision, symbol); NULL without digits."""
    fraction = F.regexp_extract(text, ASSET_PATTERN, 3)
    parsed = F.struct(
        F.concat(
            F.regexp_extract(text, ASSET_PATTERN, 1),
            F.regexp_extract(text, ASSET_PATTERN, 2),
            fraction,
        ).alias("amount"),
        F.length(fraction).alias("precision"),
        F.regexp_replace(F.regexp_extract(text, ASSET_PATTERN, 4), r"^\s+|\s+$", "").alias("symbol"),
    )
    return F.when(text.rlike(ASSET_PATTERN), parsed)


def asset_to_wei(amount: Column) -> Column:
    """Amount digits to the smallest unit; NULL when the product has over 38 digits."""
    factor = F.lit(10**K.ASSET_SCALE_DIGITS).cast("decimal(15,0)")
    return F.try_multiply(amount.try_cast("decimal(24,0)"), factor).cast("decimal(38,0)")


def wei_to_whole(wei: Column) -> Column:
    """Whole tokens in an amount of the smallest unit, cut off, as text."""
    text = wei.cast("decimal(38,0)").cast("string")
    return F.when(F.length(text) <= K.WHOLE_TOKEN_DIGITS, F.lit("0")).otherwise(
        F.substr(text, F.lit(1), F.length(text) - K.WHOLE_TOKEN_DIGITS)
    )


def name_to_uint64(name: Column) -> Column:
    """Base-32 account name to its unsigned 64-bit number, as DECIMAL(20,0).

    Twelve characters of five bits are read as one base-32 number, a thirteenth adds
    four bits; unknown characters count 0.
    """
    known = F.regexp_replace(name, "[^1-5a-z]", ".")
    digits = F.translate(F.rpad(F.substring(known, 1, 12), 12, "."), K.NAME_ALPHABET, K.BASE32_DIGITS)
    last = F.instr(F.lit(K.NAME_ALPHABET), F.substring(F.rpad(known, 13, "."), 13, 1)) - 1
    head = F.conv(digits, 32, 10).cast("decimal(19,0)") * F.lit(16).cast("decimal(2,0)")
    return (head + last.bitwiseAND(F.lit(15)).cast("decimal(2,0)")).cast("decimal(20,0)")


def is_integer(text: Column) -> Column:
    return text.rlike(r"\A(0|-?[1-9][0-9]*)\z")


def is_bare_hex(text: Column) -> Column:
    return text.rlike(r"\A[0-9a-fA-F]+\z")


def is_hex(text: Column) -> Column:
    """Hex digits, ``0x`` and no digits at all allowed."""
    return text.rlike(r"\A(0x)?[0-9a-fA-F]*\z")


def is_bare_address(text: Column) -> Column:
    return text.rlike(r"\A[0-9a-fA-F]{40}\z")


def is_address(text: Column) -> Column:
    return text.rlike(r"\A0x[0-9a-fA-F]{40}\z")


def is_bare_hash(text: Column) -> Column:
    return text.rlike(r"\A[0-9a-fA-F]{64}\z")


def is_hash(text: Column, strict: bool = False) -> Column:
    """66 characters of hex. Without ``strict`` 66 digits and no prefix pass as well."""
    if strict:
        return text.rlike(r"\A0x[0-9a-fA-F]{64}\z")
    return (F.length(text) == 66) & is_hex(text)


def is_asset(text: Column) -> Column:
    """Amount and a symbol of one to seven capitals."""
    return text.rlike(r"\A-?[0-9]+(\.[0-9]+)? [A-Z]{1,7}\z")


def is_timestamp(text: Column) -> Column:
    return text.cast("string").try_cast("timestamp").isNotNull()


def epoch_seconds(ts: Column) -> Column:
    """UTC epoch seconds, cut off downwards."""
    return F.unix_seconds(ts.cast("timestamp"))


def iso_second(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def deposit_target(memo: Column, address: Column) -> Column:
    """A valid address in the memo wins; otherwise the sender's own address."""
    return F.when(is_address(memo), F.lower(memo)).when(
        address.isNotNull(), F.concat(F.lit("0x"), F.lower(strip_0x(address)))
    )


def empty_to_null(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def evm_number(native: Column, delta: int) -> Column:
    return native - F.lit(delta)


def segment_of(block_num: Column, per_segment: int = K.BLOCKS_PER_SEGMENT) -> Column:
    return F.call_function("div", block_num, F.lit(per_segment).cast("bigint"))


def segment_label(segment: Column) -> Column:
    return F.lpad(segment.cast("string"), 8, "0")

