"""Forks: finding them in an arrival log and keeping the canonical chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.operators.ordered import minimum_after, neighbours


def with_previous_arrival(
    arrivals: DataFrame, by: Sequence[str] = (), width: int = K.ORDER_BUCKET
) -> DataFrame:
    """Adds ``prev_n``, the number of the arrival before this one."""
    return neighbours(arrivals, "arrival_seq", {"prev_n": "n"}, by=by, width=width)


def fork_events(arrivals: DataFrame, by: Sequence[str] = (), width: int = K.ORDER_BUCKET) -> DataFrame:
    """One row per arrival that does not go up: the chain was reorganised there."""
    kept = [name for name in (*by, "arrival_seq", "ts") if name in arrivals.columns]
    return (
        with_previous_arrival(arrivals, by, width)
        .where(F.col("n") <= F.col("prev_n"))
        .select(*kept, (F.col("n") - 1).alias("last_non_forked"), F.col("prev_n").alias("last_forked"))
    )


def sequence_gaps(arrivals: DataFrame, by: Sequence[str] = (), width: int = K.ORDER_BUCKET) -> DataFrame:
    """Arrivals that jump ahead of the one before: the reader skipped blocks there.

    ``canonical_chain`` and ``fork_events`` are the live gate's result for logs
    without such rows, so a batch job looks here first.
    """
    kept = [name for name in (*by, "arrival_seq", "ts") if name in arrivals.columns]
    return (
        with_previous_arrival(arrivals, by, width)
        .where(F.col("n") > F.col("prev_n") + 1)
        .select(*kept, "n", (F.col("prev_n") + 1).alias("expected"))
    )


def canonical_chain(arrivals: DataFrame, by: Sequence[str] = (), width: int = K.ORDER_BUCKET) -> DataFrame:
    """Arrivals that survive all later forks.

    A fork to number m throws away every earlier arrival from m on, so an arrival
    stays exactly if no later one has its number or a lower one.
    """
    return (
        minimum_after(arrivals, "arrival_seq", "n", "_later_low", by=by, width=width)
        .where(F.col("_later_low").isNull() | (F.col("_later_low") > F.col("n")))
        .drop("_later_low")
    )


def discarded(arrivals: DataFrame, by: Sequence[str] = (), width: int = K.ORDER_BUCKET) -> DataFrame:
    """The arrivals ``canonical_chain`` leaves out."""
    return (
        minimum_after(arrivals, "arrival_seq", "n", "_later_low", by=by, width=width)
        .where(F.col("_later_low") <= F.col("n"))
        .drop("_later_low")
    )


def double_forks(
    forks: DataFrame,
    max_distance: int = K.DOUBLE_FORK_DISTANCE,
    position: str = "arrival_seq",
    width: int = K.ORDER_BUCKET,
) -> DataFrame:
    """Forks that start within ``max_distance`` of the fork before, backwards included."""
    linked = neighbours(forks, position, {"prev_last_non_forked": "last_non_forked"}, width=width)
    return linked.where(F.col("last_non_forked") - F.col("prev_last_non_forked") < max_distance)


def old_hashes(forks: DataFrame, blocks: DataFrame) -> DataFrame:
    """Hash the chain continues from after each fork: that of the last good block."""
    points = forks.select("last_non_forked").distinct()
    stored = blocks.select(F.col("block_num").alias("last_non_forked"), F.col("evm_hash").alias("old_hash"))
    hashes = stored.join(points, "last_non_forked", "left_semi").distinct()
    return forks.join(hashes, "last_non_forked", "left")


def without_discarded(df: DataFrame, forks: DataFrame, column: str = "block_num") -> DataFrame:
    """Rows of a not yet written batch that a single fork log leaves in place.

    Everything above the lowest ``last_non_forked`` of the log goes.
    """
    floor = forks.agg(F.min("last_non_forked").alias("floor")).first().floor
    return df if floor is None else df.where(F.col(column) <= floor)
