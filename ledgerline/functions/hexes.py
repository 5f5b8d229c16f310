"""Hex text and wide integers as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K

# 15 hex digits are 60 bits: the sum of two such limbs still fits a signed LONG.
LIMB = 15


def to_hex(data: Column) -> Column:
    """Bytes to lower-case hex; no bytes at all give empty text."""
    return F.coalesce(F.lower(F.hex(data)), F.lit(""))


def packed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Hex text as bytes, half as long, for a shuffle; what isn't plain lower-case hex stays text. ``unpacked`` undoes it."""
    for name in names:
        data, text = F.unhex(F.col(name)), F.col(name)
        df = df.withColumn(f"_packed_{name}", F.when(F.lower(F.hex(data)) == text, data))
        df = df.withColumn(name, F.when(F.col(f"_packed_{name}").isNull(), text))
    return df


def unpacked(df: DataFrame, names: Sequence[str]) -> DataFrame:
    texts = {name: F.coalesce(F.lower(F.hex(f"_packed_{name}")), F.col(name)) for name in names}
    return df.withColumns(texts).drop(*[f"_packed_{name}" for name in names])


def strip_0x(text: Column) -> Column:
    return F.regexp_replace(text, "^0x", "")


def add_0x(text: Column) -> Column:
    return F.concat(F.lit("0x"), strip_0x(text))


def from_hex(text: Column, strict: bool = True) -> Column:
    """Hex text (``0x`` allowed) to bytes. Odd length raises, or gives NULL if not strict."""
    body = strip_0x(text)
    odd = F.length(body) % 2 != 0
    bad = F.raise_error(F.concat(F.lit("Invalid hex string: "), text)) if strict else F.lit(None)
    return F.when(odd, bad.cast("binary")).otherwise(F.unhex(body))


def pad_hex(text: Column, digits: int) -> Column:
    """Left pad with zeros; longer text is kept whole."""
    return F.when(F.length(text) >= digits, text).otherwise(F.lpad(text, digits, "0"))


def strip_zeros(text: Column) -> Column:
    return F.regexp_replace(text, "^0+", "")


def unpad_hex(text: Column) -> Column:
    """``0x`` text without leading zeros; zero is ``0x``."""
    return F.concat(F.lit("0x"), strip_zeros(strip_0x(text)))


def bare_hex(text: Column) -> Column:
    """Hex digits without prefix or leading zeros; zero is ``0``."""
    return F.regexp_replace(F.concat(F.lit("0"), strip_0x(F.lower(text))), "^0+(?=.)", "")


def trim_input(text: Column, digits: int = K.INPUT_TRIM) -> Column:
    return F.substring(text, 1, digits)


def _limb(text: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(text, start, digits), 16, 10).cast("bigint")


def _limb_hex(limb: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.hex(limb)), digits, "0")


def _increment(digits: Column) -> Column:
    """Hex digits plus one: the last digit below f goes up, the f's after it turn 0."""
    parts = r"\A([0-9a-f]*)([0-9a-e])(f*)\z"
    raised = F.translate(F.regexp_extract(digits, parts, 2), "0123456789abcde", "123456789abcdef")
    zeros = F.regexp_replace(F.regexp_extract(digits, parts, 3), "f", "0")
    return F.when(
        digits.rlike(parts), F.concat(F.regexp_extract(digits, parts, 1), raised, zeros)
    ).otherwise(F.concat(F.lit("1"), F.regexp_replace(digits, "f", "0")))


def hex_plus(text: Column, addend: Column) -> Column:
    """256-bit sum of hex text and a LONG below 2^60, as hex without leading zeros.

    The last 15 digits are added as a LONG; only a carry out of them, which is rare,
    touches the digits before.
    """
    full = F.lpad(strip_0x(F.lower(text)), 64, "0")
    head = F.substring(full, 1, 64 - LIMB)
    low = _limb(full, 64 - LIMB + 1, LIMB) + addend.cast("bigint")
    fits = low < F.lit(2**60)
    tail = _limb_hex(low.bitwiseAND(F.lit(2**60 - 1)), LIMB)
    return bare_hex(F.concat(F.when(fits, head).otherwise(_increment(head)), tail))


def hex_to_decimal(text: Column) -> Column:
    """Hex text to DECIMAL(38,0); NULL for text that is not hex or does not fit."""
    body = strip_0x(text)
    digits = bare_hex(text)
    full = F.lpad(digits, 32, "0")
    high = F.conv(F.substring(full, 1, 16), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(full, 17, 16), 16, 10).cast("decimal(20,0)")
    wide = F.try_add(
        F.try_multiply(high, F.lit(str(2**64)).cast("decimal(20,0)")).cast("decimal(38,0)"), low
    )
    fits = body.rlike(r"\A[0-9a-fA-F]+\z") & (F.length(digits) <= 32)
    # 2^126 is the largest power of two below 10^38.
    small = (F.length(digits) < 32) | (F.substring(digits, 1, 1) < "4")
    return F.when(fits & small, wide.cast("decimal(38,0)"))


def decimal_to_hex(number: Column) -> Column:
    """Non-negative DECIMAL(38,0) to hex digits without leading zeros; zero is ``0``."""
    whole = number.cast("decimal(38,0)")
    limbs = []
    for power in (96, 64, 32, 0):
        base = F.lit(str(2**power)).cast("decimal(29,0)")
        # The difference is a multiple of the base, so the quotient is exact.
        quotient = ((whole - whole % base) / base).cast("decimal(38,0)") if power else whole
        limbs.append(_limb_hex((quotient % F.lit(2**32).cast("decimal(10,0)")).cast("bigint"), 8))
    return F.when(number >= 0, bare_hex(F.concat(*limbs)))


def num_to_hex(number: Column) -> Column:
    """Integer or integer text up to 38 digits to ``0x`` hex."""
    return F.concat(F.lit("0x"), decimal_to_hex(number.cast("decimal(38,0)")))


def long_to_hex(number: Column) -> Column:
    """Non-negative LONG to ``0x`` hex."""
    return F.concat(F.lit("0x"), F.lower(F.hex(number.cast("bigint"))))


def synthetic_vrs(block_hash: Column, sender: Column, index: Column) -> Column:
    """V, R and S of a transaction that carries no signature of its own."""
    s_digits = F.rpad(strip_0x(F.lower(sender)), 64, "0")
    return F.struct(
        F.lit(str(K.SYNTHETIC_V)).alias("v"),
        unpad_hex(hex_plus(block_hash, index)).alias("r"),
        unpad_hex(s_digits).alias("s"),
    )
