"""Band joins: positions that lie in intervals, without comparing all with all.

The line is cut into cells, wider ones for wider intervals: four times the width from each level to the next.
An interval lies at the level whose cells are about as wide as itself, so it touches two of them, three at most, and a
position looks only at the levels that hold intervals. Both sides then meet by an equi join on level and cell.
Cells that hold very many rows are cut into a grid of parts: each part of one side meets each part of the other in a
task of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of either side that one part of a cell holds, about.
PART_ROWS = 100_000
GROWTH = 4
CELL = ["_level", "_cell"]


def _cell(position: Column, level: Column, width: int) -> Column:
    """Floor division by the width of the level's cells."""
    size = (F.lit(width) * F.pow(F.lit(float(GROWTH)), level)).cast("bigint")
    return F.call_function("div", position - F.pmod(position, size), size)


def band_join(points: DataFrame, intervals: DataFrame, at: str, low: str, high: str, width: int, part_rows: int = PART_ROWS) -> DataFrame:
    """Every pair of a row of ``points`` and a row of ``intervals`` with ``low <= at <= high``, as one row with the columns of both.

    The three are LONG and the column names of both sides differ. ``width`` is the width of the narrowest cells: the usual
    length of an interval. Nulls and intervals that end before they begin meet nothing; rows that repeat count as often
    as they occur. Equal rows of a cell stay in one part; the engine splits such a partition of the join by itself.
    """
    length = F.greatest((F.col(high) - F.col(low) + 1) / F.lit(width), F.lit(1.0))
    level = F.ceil(F.log(float(GROWTH), length)).cast("int")
    placed = intervals.where(F.col(low) <= F.col(high)).withColumn("_level", level)
    levels = placed.agg(F.collect_set("_level").alias("levels")).scalar()  # some thirty at most
    first, last = (_cell(F.col(c), F.col("_level"), width) for c in (low, high))
    placed = placed.withColumn("_cell", F.explode(F.sequence(first, last)))
    seen = points.where(F.col(at).isNotNull()).withColumn("_level", F.explode(levels))
    seen = seen.withColumn("_cell", _cell(F.col(at), F.col("_level"), width))

    parts = lambda df, out: df.groupBy(*CELL).agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias(out))
    heavy = parts(placed, "_of_intervals").join(parts(seen, "_of_points"), CELL).where("_of_intervals > 1 or _of_points > 1")
    one = F.lit(1)
    split = lambda df, own, other, mine, theirs: (
        df.join(heavy, CELL, "left")
        .withColumn(mine, F.pmod(F.xxhash64(*df.columns), F.coalesce(own, one)).cast("int"))
        .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.coalesce(other, one) - 1)))
        .drop("_of_intervals", "_of_points")
    )
    of_points, of_intervals = F.col("_of_points"), F.col("_of_intervals")
    seen = split(seen, of_points, of_intervals, "_point_part", "_interval_part")
    placed = split(placed, of_intervals, of_points, "_interval_part", "_point_part")
    keys = [*CELL, "_point_part", "_interval_part"]
    return seen.join(placed, keys).where(F.col(at).between(F.col(low), F.col(high))).drop(*keys)
