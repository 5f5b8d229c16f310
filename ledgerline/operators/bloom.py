"""Log blooms: 2048 bits as 512 hex digits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.codec import BLOOM_BYTES, bloom_words, logs_bloom

EMPTY_BLOOM = "00" * BLOOM_BYTES


def bloom_build(txs: DataFrame, logs: str = "logs") -> DataFrame:
    """``logs_bloom`` of each row from its logs; rows stay where they are."""
    return txs.withColumn("logs_bloom", logs_bloom(F.col(logs)))


_WORDS = "_words"


def with_words(txs: DataFrame, bloom: str = "logs_bloom") -> DataFrame:
    """Adds the 32 words of 64 bits that ``bloom_union`` combines, worked out once a row; NULL without a bloom."""
    data = F.unhex(F.when(F.col(bloom) != "", F.col(bloom)))
    # The function rpad pads bytes with bytes and cuts what is longer, as the aggregate over words needs it.
    return txs.withColumn(_WORDS, bloom_words(F.rpad(data, BLOOM_BYTES, F.lit(bytearray(1)))))


def bloom_union() -> Column:
    """Aggregate over rows ``with_words``: bitwise OR of all blooms of a group, 512 zeros for none.

    Every word is a buffer of fixed width: rows are hashed and combined map-side, so a busy block shuffles one bloom
    per task. The engine's bitmap aggregate has a buffer of 4 KB and sorts its rows.
    """
    words = [F.bit_or(F.col(_WORDS)[i]) for i in range(BLOOM_BYTES // 8)]
    return F.lower(F.concat(*[F.lpad(F.hex(F.coalesce(word, F.lit(0).cast("bigint"))), 16, "0") for word in words]))


def bloom_or(txs: DataFrame, by: str | Sequence[str], bloom: str = "logs_bloom") -> DataFrame:
    """Bitwise OR of all blooms per key, for keys with at least one."""
    keys = [by] if isinstance(by, str) else list(by)
    with_logs = txs.where(F.col(bloom).isNotNull() & (F.col(bloom) != ""))
    return with_words(with_logs, bloom).groupBy(*keys).agg(bloom_union().alias("logs_bloom"))
