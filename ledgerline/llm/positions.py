"""Places of rows in the order of their group, without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import staged


def numbered(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``pos``, counted from 0 in the order of ``order`` (nulls first) inside ``group``, and ``n``, the group's size.

    The whole table is cut into ranges of (group, order), so a group of any size lies in as many ranges as it needs. A
    row's place is the sizes of its group's earlier ranges plus its place in its own. Only rows equal in all of
    ``order`` end in one range for certain. ``group`` holds no nulls.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    cut = rows.repartitionByRange(F.col(group), *keys).withColumn("__range", F.spark_partition_id())
    cut = staged(cut, f"{label}-ranges")
    sizes = cut.groupBy(group, "__range").agg(F.count("*").alias("__size"))
    before = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumns(
        {"__before": F.coalesce(F.sum("__size").over(before), F.lit(0)), "n": F.sum("__size").over(Window.partitionBy(group))}
    )
    inside = F.row_number().over(Window.partitionBy(group, "__range").orderBy(*keys)) - 1
    placed = cut.withColumn("__inside", inside.cast("long")).join(sizes.drop("__size"), [group, "__range"])
    return placed.withColumn("pos", F.col("__before") + F.col("__inside")).drop("__range", "__before", "__inside")
