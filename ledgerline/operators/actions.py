"""From native actions to the accepted ones: filters, kinds, first copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.operators.ordered import bucket_of

DEPOSIT, WITHDRAW, RAW = "deposit", "withdraw", "raw"


def whitelisted(whitelist: dict[str, list[str]] | None = None) -> Column:
    """Predicate on (account, name) pairs; plain comparisons, so scans push it down."""
    condition = F.lit(False)
    for account, names in (whitelist or K.ACTION_WHITELIST).items():
        condition = condition | ((F.col("account") == account) & F.col("name").isin(list(names)))
    return condition


def classify_actions(actions: DataFrame, exclude_senders: Sequence[str] = ()) -> DataFrame:
    """Accepted actions with their ``kind``: raw, withdraw or deposit.

    A transfer notifies several accounts with one digest; only the notice to the
    EVM contract counts. Actions without a kind yield no row.
    """
    on_evm = F.col("account") == K.EVM_CONTRACT
    transfer = (F.col("account") == K.TOKEN_CONTRACT) & (F.col("name") == K.TRANSFER_ACTION)
    kind = (
        F.when(on_evm & (F.col("name") == K.RAW_ACTION), RAW)
        .when(on_evm & (F.col("name") == K.WITHDRAW_ACTION), WITHDRAW)
        .when(transfer & (F.col("data.to") == K.EVM_CONTRACT), DEPOSIT)
    )
    kept = actions.where(whitelisted()).where(
        ~transfer | (F.col("receiver").eqNullSafe(F.lit(K.EVM_CONTRACT)))
    )
    if exclude_senders:
        kept = kept.where(~transfer | ~F.coalesce(F.col("data.from").isin(list(exclude_senders)), F.lit(False)))
    return kept.withColumn("kind", kind).where(F.col("kind").isNotNull())


def dedup_actions(actions: DataFrame) -> DataFrame:
    """First action of each digest in a block.

    A top-1 per group: Spark drops all later copies map-side before the shuffle, so
    a digest that is copied very often does not gather in one task.
    """
    first = W.partitionBy("block_num", "act_digest").orderBy("action_seq")
    return actions.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")


def in_several_parts(actions: DataFrame, width: int) -> DataFrame:
    """All actions of the blocks that are ranked in more than one part of ``width``; mostly there are none, and no row is read."""
    part = F.coalesce(bucket_of(F.col("action_seq").cast("bigint"), width), F.lit(-(2**63)))
    spans = actions.groupBy("block_num").agg(F.min(part).alias("_first"), F.max(part).alias("_last"), F.count(F.lit(1)).alias("_rows"))
    blocks = spans.where((F.col("_first") < F.col("_last")) | (F.col("_rows") > width)).select("block_num")
    some = blocks.select(F.count(F.lit(1)) > 0).scalar()
    return actions.where(some).join(blocks, "block_num", "left_semi")


def unique_accounts(accounts: DataFrame) -> DataFrame:
    """Accounts with exactly one row; ambiguous ones do not resolve."""
    return (
        accounts.groupBy("account")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("address").alias("address"))
        .where("_rows = 1")
        .drop("_rows")
    )


def ambiguous_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.groupBy("account").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def with_address(df: DataFrame, account: str, accounts: DataFrame) -> DataFrame:
    """Adds the EVM ``address`` of an account column; NULL without exactly one match.

    A plain left join: adaptive execution broadcasts a small side, and splits the partition of
    an account (or of NULL) with very many actions.
    """
    side = unique_accounts(accounts).withColumnRenamed("account", account)
    return df.join(side, account, "left")
