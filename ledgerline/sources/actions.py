"""Sources of native actions and of account rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.actions import whitelisted


def read_actions(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    whitelist: dict[str, list[str]] | None = None,
    fmt: str = "parquet",
    start: int | None = None,
    stop: int | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Actions of whitelisted contracts, batch or stream, with an explicit schema.

    Whitelist and block bounds are plain comparisons on stored columns, so Parquet
    skips row groups by them.
    """
    if stream:
        reader = spark.readStream.schema(S.ACTIONS).format(fmt)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = spark.read.schema(S.ACTIONS).format(fmt)
    actions = reader.load(path).where(whitelisted(whitelist))
    if start is not None:
        actions = actions.where(F.col("block_num") >= start)
    if stop is not None and stop > 0:
        actions = actions.where(F.col("block_num") <= stop)
    return actions


def irreversible(df: DataFrame, last_irreversible: int | str, column: str = "block_num") -> DataFrame:
    """Rows that can no longer be forked away: up to a number, or to a column of it."""
    limit = F.col(last_irreversible) if isinstance(last_irreversible, str) else F.lit(last_irreversible)
    return df.where(F.col(column) <= limit)


def read_accounts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(S.ACCOUNTS).format(fmt).load(path)
