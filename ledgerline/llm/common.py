"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns an operator is about to add, whatever their case."""
    taken = {name.lower() for name in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def quoted(name: str) -> Column:
    """A column by its very name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the one that driver and executors share."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Batches of at most ``rows`` rows between engine and Python, for what runs inside: wide rows by the thousand fill both."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def give_back() -> None:
    """Hand freed memory back to the machine: a worker that a large model bloated goes on to serve other stages."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of one C library only
    if trim is not None:
        trim(0)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it holds at most ``rows`` rows; else it is shuffled as usual.

    Call it on narrow, staged tables only: the count is a job of its own.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, also where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))
