"""Comparison of two tables that should be equal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row versions whose number of copies differs, with both numbers.

    One aggregation over the union: equal rows meet map-side or in the shuffle and
    vanish, and no key ever pairs its copies with each other.
    """
    columns = left.columns
    tagged = (
        left.select(*columns, F.lit(1).cast("bigint").alias("_l"), F.lit(0).cast("bigint").alias("_r"))
    ).unionByName(
        right.select(*columns, F.lit(0).cast("bigint").alias("_l"), F.lit(1).cast("bigint").alias("_r"))
    )
    return (
        tagged.groupBy(*columns)
        .agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
        .where("n_left <> n_right")
    )


def compare_tables(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Differences as rows (status, key, diff_columns, n_left, n_right).

    ``differs`` has one version of the key on each side and names the columns;
    ``only_left`` and ``only_right`` have the key on one side; ``copies`` is a key
    with several versions or unequal numbers of copies, counted but not paired.
    """
    keys = [key] if isinstance(key, str) else list(key)
    values = [name for name in left.columns if name not in keys]
    versions = differing_rows(left, right).withColumns(
        {
            "_lv": (F.col("n_left") > 0).cast("int"),
            "_rv": (F.col("n_right") > 0).cast("int"),
        }
    )
    # For a key with one version per side the minimum over a side is that version.
    sides = []
    for side, count in (("l", "n_left"), ("r", "n_right")):
        for i, name in enumerate(values):
            sides.append(F.max(F.when(F.col(count) > 0, F.struct(F.col(name).alias("x")))).alias(f"_{side}{i}"))
    grouped = versions.groupBy(*keys).agg(
        F.sum("n_left").alias("n_left"),
        F.sum("n_right").alias("n_right"),
        F.sum("_lv").alias("_lv"),
        F.sum("_rv").alias("_rv"),
        *sides,
    )
    single = (F.col("_lv") == 1) & (F.col("_rv") == 1) & (F.col("n_left") == 1) & (F.col("n_right") == 1)
    status = (
        F.when(F.col("n_right") == 0, "only_left")
        .when(F.col("n_left") == 0, "only_right")
        .when(single, "differs")
        .otherwise("copies")
    )
    changed = F.array_compact(
        F.array(
            *[
                F.when(~F.col(f"_l{i}.x").eqNullSafe(F.col(f"_r{i}.x")), F.lit(name))
                for i, name in enumerate(values)
            ]
        )
    )
    return grouped.select(
        status.alias("status"),
        *keys,
        F.when(single, F.array_join(changed, ",")).otherwise(F.lit("")).alias("diff_columns"),
        "n_left",
        "n_right",
    )


def row_digests(columns: list[str]) -> list[Column]:
    """Two sums of 64-bit digests and a count: equal for equal rows in any order, and they add up over parts."""
    wide = lambda digest: F.sum(digest.cast("decimal(20,0)"))
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    return [F.count(F.lit(1)).alias("n"), wide(first).alias("d1"), wide(second).alias("d2")]


def differing_parts(left: DataFrame, right: DataFrame, parts: list[str], columns: list[str]) -> DataFrame:
    """Parts of two tables whose digests aren't the same, or that one side lacks."""
    digests = row_digests(columns)
    both = left.groupBy(*parts).agg(*digests).unionByName(right.groupBy(*parts).agg(*digests))
    ends = both.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("sides"), *[F.min(c).alias(f"{c}_lo") for c in DIGESTS], *[F.max(c).alias(f"{c}_hi") for c in DIGESTS]
    )
    same = (F.col("sides") == 2) & (F.col("n_lo") == F.col("n_hi")) & (F.col("d1_lo") == F.col("d1_hi")) & (F.col("d2_lo") == F.col("d2_hi"))
    return ends.where(~same).select(*parts)


DIGESTS = ("n", "d1", "d2")


def compare_by_digests(
    left: DataFrame, right: DataFrame, key: str | Sequence[str], part: Column, buckets: int = 1024
) -> DataFrame:
    """The rows of ``compare_tables``, found by descending a tree of digests: part, bucket of keys, row.

    ``part`` (a segment, say) is a function of the key. Every part is one row of digests, made where its rows lie; only
    parts that differ are cut into ``buckets`` by key, and only rows of buckets that differ are shuffled and compared. Rows of
    equal parts never move. Null parts and keys are parts and keys of their own.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = left.columns
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    sides = [side.select(*columns, F.struct(part.alias("p")).alias("_part")) for side in (left, right.select(*columns))]
    apart = differing_parts(*sides, ["_part"], columns)
    sides = [side.join(apart, "_part", "left_semi").withColumn("_bucket", bucket) for side in sides]
    apart = differing_parts(*sides, ["_part", "_bucket"], columns)
    sides = [side.join(apart, ["_part", "_bucket"], "left_semi").select(*columns) for side in sides]
    return compare_tables(*sides, key)


def require_equal(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> None:
    """Raise unless both tables hold the same rows."""
    found = compare_tables(left, right, key).limit(1).collect()
    if found:
        raise ValueError(f"tables differ: {found[0].asDict()}")
