"""Ordered scroll: a stored range of any length, handed over a bounded batch at a time.

The range is counted by slots of ``batch`` numbers, one narrow aggregation that reads the number column only. Neighbouring slots
are put together as long as they hold ``batch`` rows at most; each such span is a range scan of its own, which
prunes segments and row groups. ``prefetch`` spans are fetched at a time while the caller works on an earlier one, so the driver holds
``prefetch`` + 1 batches, whatever the range. Slots whose numbers repeat beyond ``batch`` rows come in several batches.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import closing
from itertools import islice
from typing import NamedTuple

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.operators.ordered import bucket_of
from ledgerline.operators.scans import in_range


class Span(NamedTuple):
    """Numbers that are fetched together, and how many rows have them."""

    lo: int
    hi: int
    rows: int


class InvalidRow(ValueError):
    """A row that breaks the rules it was asked to meet."""


def slots(df: DataFrame, column: str, batch: int) -> DataFrame:
    """Rows, least and largest number of each slot of ``batch`` numbers; rows without a number are in none."""
    numbered = df.where(F.col(column).isNotNull())
    return numbered.groupBy(bucket_of(F.col(column), batch).alias("slot")).agg(
        F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("n")
    )


def spans(df: DataFrame, column: str, batch: int) -> Iterator[Span]:
    """Spans in order. One row per slot passes, never more than a partition of them at a time."""
    held: Span | None = None
    for slot in slots(df, column, batch).orderBy("slot").toLocalIterator():
        if held is not None and held.rows + slot.n <= batch:
            held = Span(held.lo, slot.hi, held.rows + slot.n)
            continue
        if held is not None:
            yield held
        held = Span(slot.lo, slot.hi, slot.n)
    if held is not None:
        yield held


def scroll(
    table: DataFrame,
    lo: int | None = None,
    hi: int | None = None,
    batch: int = 2000,
    order: Sequence[str] = ("block_num",),
    fields: Sequence[str] | None = None,
    validate: Callable[[DataFrame], DataFrame] | None = None,
    prefetch: int = 2,
    per_segment: int | None = K.BLOCKS_PER_SEGMENT,
    shift: int = 0,
) -> Iterator[list[Row]]:
    """Lists of at most ``batch`` rows, all rows of the range in ``order``; its first column is the number that is ranged over.

    ``validate`` adds ``violations``, as the functions of ``operators.validate`` do; a row that has some raises. It sees whole
    rows, also where only ``fields`` are asked for. An empty range gives no list.
    """
    if batch < 1 or prefetch < 1:
        raise ValueError("batch and prefetch are at least 1")
    column = order[0]
    ranged = in_range(table, column, lo, hi, per_segment, shift)
    wanted = list(table.columns if fields is None else dict.fromkeys([*order, *fields]))

    def rows_of(span: Span) -> DataFrame:
        found = in_range(table, column, span.lo, span.hi, per_segment, shift)
        if validate is not None:
            found = validate(found).withColumn("violations", F.when(F.size("violations") > 0, F.col("violations")))
            return found.select(*wanted, F.col("violations").alias("_broken")).orderBy(*order)
        return found.select(*wanted).orderBy(*order)

    def checked(rows: list[Row]) -> list[Row]:
        if validate is None:
            return rows
        for row in rows:
            if row["_broken"]:
                raise InvalidRow(f"{column} {row[column]}: {', '.join(map(str, row['_broken']))}")
        return [Row(**{name: row[name] for name in wanted}) for row in rows]

    def fetched(span: Span):
        # Within the batch: at once, ahead of its turn. Beyond it: piece by piece, when it is its turn.
        return rows_of(span).collect() if span.rows <= batch else None

    with ThreadPoolExecutor(prefetch) as pool, closing(spans(ranged, column, batch)) as found:
        ahead = deque((span, pool.submit(fetched, span)) for span in islice(found, prefetch))
        while ahead:
            span, future = ahead.popleft()
            rows = future.result()
            ahead.extend((following, pool.submit(fetched, following)) for following in islice(found, 1))
            if rows is not None:
                yield checked(rows)
                continue
            pieces = rows_of(span).toLocalIterator()
            while piece := list(islice(pieces, batch)):
                yield checked(piece)
