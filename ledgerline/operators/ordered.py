"""Ordered work at scale: running totals, neighbours and folds in bounded groups.

A window without partitions, or over one key that holds a third of the table, ends
in a single task. Everything here cuts the order into buckets first, works inside
the buckets in parallel, and carries only one row per bucket across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions.hexes import packed, unpacked

_BUCKET = "_bucket"
#: Cells that rows are counted by before their keys are.
_CELLS = 65_536


def bucket_of(position: Column, width: int) -> Column:
    """Floor division of a LONG, right for negative numbers too."""
    shifted = position - F.pmod(position, F.lit(width))
    return F.call_function("div", shifted, F.lit(width).cast("bigint"))


def large_keys(df: DataFrame, by: str, width: int = K.BLOCK_PART) -> DataFrame:
    """Keys of more than ``width`` rows, few enough to be broadcast. NULL isn't one of them.

    Rows are counted by cells of many keys first, which little is shuffled for, and by keys only in cells of more than
    ``width`` rows: mostly in none.
    """
    keys = df.where(F.col(by).isNotNull()).select(by, F.pmod(F.hash(by), F.lit(_CELLS)).alias("_cell"))
    cells = keys.groupBy("_cell").count().where(F.col("count") > width)
    counts = keys.join(F.broadcast(cells), "_cell", "left_semi").groupBy(by).count()
    return counts.where(F.col("count") > width).select(by)


def running_totals(
    df: DataFrame,
    by: str,
    order: Sequence[str],
    spread: Column,
    measures: dict[str, Column],
    hexes: Sequence[str] = (),
    several: DataFrame | None = None,
    stretch: Column | None = None,
) -> DataFrame:
    """Inclusive running sum of each measure per ``by``, in ``order``.

    ``spread`` is a LONG that never falls along the order and cuts every key into buckets. The
    buckets are summed in parallel; a bucket that isn't the first of its key starts
    from the total of those before it. Most keys are one bucket and get no offset row.
    Columns of ``hexes``, which the order and the measures don't need, are shuffled as bytes.
    ``several`` are all rows of each key that may have more than one bucket, so that ``df`` isn't worked out a second time
    for the offsets.
    ``stretch`` is a LONG that never falls along the order and is worked out after the shuffle: a sum is NULL where its
    stretch has held only NULLs so far. Without it, buckets take that part.
    """
    cut = packed(df.withColumn(_BUCKET, spread.cast("bigint")), hexes)
    inner = W.partitionBy(by, _BUCKET).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = {name: F.sum(value).over(inner) for name, value in measures.items()}
    if stretch is not None:
        cut = cut.repartition(by, _BUCKET).withColumn("_stretch", F.coalesce(stretch, F.lit(-(2**63))))
        held = {name: F.max(F.when(value.isNotNull(), F.col("_stretch"))).over(inner) for name, value in measures.items()}
        local = {name: F.when(held[name] == F.col("_stretch"), total) for name, total in local.items()}
    local = cut.withColumns(local).drop("_stretch")

    sums = {name: f"_sum_{name}" for name in measures}
    summed = cut if several is None else several.withColumn(_BUCKET, spread.cast("bigint"))
    parts = summed.groupBy(by, _BUCKET).agg(*[F.sum(value).alias(sums[name]) for name, value in measures.items()])
    before = W.partitionBy(by).orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    place = F.row_number().over(W.partitionBy(by).orderBy(_BUCKET))
    offsets = parts.select(by, _BUCKET, place.alias("_place"), *[F.sum(s).over(before).alias(s) for s in sums.values()])
    offsets = offsets.where("_place > 1").drop("_place")
    joined = local.join(offsets, [by, _BUCKET], "left")
    totals = joined.withColumns(
        {name: F.col(name) + F.coalesce(F.col(sums[name]), F.lit(0)) for name in measures}
    ).drop(_BUCKET, *sums.values())
    return unpacked(totals, hexes)


def neighbours(
    df: DataFrame,
    position: str,
    values: dict[str, str],
    after: bool = False,
    by: Sequence[str] = (),
    width: int = K.ORDER_BUCKET,
    levels: int = 2,
) -> DataFrame:
    """Values of the row before (or after) in the order of ``position``.

    ``position`` is a LONG without ties inside ``by``; ``values`` maps output names
    to non-NULL input columns. The last rows of each bucket are themselves in order,
    so they find their neighbours the same way, ``width`` times fewer rows per level.
    """
    by = list(by)
    step = F.lead if after else F.lag
    if levels == 0:
        window = W.partitionBy(*(by or [F.lit(0)])).orderBy(position)
        return df.withColumns({out: step(name).over(window) for out, name in values.items()})

    key = f"{_BUCKET}_{levels}"
    inner = W.partitionBy(*by, key).orderBy(position)
    cut = df.withColumn(key, bucket_of(F.col(position), width))
    local = cut.withColumns({out: step(name).over(inner) for out, name in values.items()})
    pick = F.min_by if after else F.max_by
    edges = cut.groupBy(*by, key).agg(
        *[pick(name, position).alias(f"_edge_{out}") for out, name in values.items()]
    )
    carried = neighbours(
        edges,
        key,
        {f"_carried_{out}": f"_edge_{out}" for out in values},
        after,
        by,
        width,
        levels - 1,
    ).select(*by, key, *[f"_carried_{out}" for out in values])
    joined = local.join(carried, [*by, key], "left")
    return joined.withColumns(
        {out: F.coalesce(F.col(out), F.col(f"_carried_{out}")) for out in values}
    ).drop(key, *[f"_carried_{out}" for out in values])


def minimum_after(
    df: DataFrame,
    position: str,
    value: str,
    out: str,
    by: Sequence[str] = (),
    width: int = K.ORDER_BUCKET,
    levels: int = 2,
) -> DataFrame:
    """Smallest ``value`` over all rows that follow in the order of ``position``."""
    by = list(by)
    if levels == 0:
        window = (
            W.partitionBy(*(by or [F.lit(0)]))
            .orderBy(F.desc(position))
            .rowsBetween(W.unboundedPreceding, -1)
        )
        return df.withColumn(out, F.min(value).over(window))

    key, later = f"{_BUCKET}_{levels}", f"_later_{levels}"
    # Descending with an unbounded start: the frame grows, it is never recomputed.
    inner = W.partitionBy(*by, key).orderBy(F.desc(position)).rowsBetween(W.unboundedPreceding, -1)
    cut = df.withColumn(key, bucket_of(F.col(position), width))
    local = cut.withColumn("_inner", F.min(value).over(inner))
    lows = cut.groupBy(*by, key).agg(F.min(value).alias("_low"))
    carried = minimum_after(lows, key, "_low", later, by, width, levels - 1).drop("_low")
    return (
        local.join(carried, [*by, key], "left")
        .withColumn(out, F.least("_inner", later))
        .drop(key, "_inner", later)
    )


def explode_range(df: DataFrame, start: Column, stop: Column, out: str, chunk: int = 10_000) -> DataFrame:
    """One row per number of ``[start, stop]``; arrays stay at ``chunk`` elements."""
    blocks = F.sequence(F.lit(0).cast("bigint"), F.call_function("div", stop - start, F.lit(chunk).cast("bigint")))
    pieces = df.withColumn("_start", start).withColumn("_stop", stop).where("_stop >= _start")
    pieces = pieces.withColumn("_piece", F.explode(blocks))
    low = F.col("_start") + F.col("_piece") * chunk
    return pieces.withColumn(
        out, F.explode(F.sequence(low, F.least(F.col("_stop"), low + F.lit(chunk - 1))))
    ).drop("_start", "_stop", "_piece")
