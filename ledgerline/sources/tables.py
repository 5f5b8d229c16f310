"""Segment-partitioned Parquet tables: create-only append, range delete, purge, load.

Parquet has no row delete. Deletes drop whole segments and, in the segment their edge
cuts, rewrite only the files that hold rows of the range. The rows that stay are
written before the old files go, and a lost job is finished by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import constants as K
from ledgerline.functions.hexes import packed, unpacked
from ledgerline.operators.scans import batch_range
from ledgerline.session import shared_folder

BLOCK_ORDER = ("segment", "block_num")
TRANSACTION_ORDER = ("segment", "block", "trx_index")
ROWS_PER_FILE = 5_000_000
COMPRESSION = "zstd"  # halves hex text
#: Columns that are mostly hex and never part of an order; shuffled as bytes.
HEX = ("hash", "block_hash", "evm_hash", "evm_prev_hash", "native_hash", "receipts_root", "transactions_root", "logs_bloom")
_REPLACE = "_replace-"


@contextmanager
def staged(df: DataFrame):
    """The rows written once to the shared folder, and read back from there.

    For a result that is checked before it is written: its plan runs once, and a
    lost executor costs a read of the copy, not the plan.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    df.write.option("compression", COMPRESSION).parquet(folder)
    try:
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        fs, target = _fs(spark, folder)
        fs.delete(target, True)


class KeyClash(ValueError):
    """A row of a create-only append is stored already."""


class NotContiguous(ValueError):
    """A batch does not start right after the last stored block."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds a table (a partition or a data file)."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return False
    return any(
        not status.getPath().getName().startswith(("_", ".")) for status in fs.listStatus(target)
    )


def stored_segments(spark: SparkSession, path: str) -> list[int]:
    """Segments of a table from the folder listing, in order; no data is read."""
    return numbered_folders(spark, path, "segment=")


def numbered_folders(spark: SparkSession, path: str, start: str) -> list[int]:
    """Numbers of the folders below ``path`` whose names begin so, in order."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(int(name.removeprefix(start)) for name in names if name.startswith(start))


def segment_files(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``(segment, files)``: a digest of what the file listing says of each segment, over tables given by name.

    Names, sizes and times of the files; no file is opened. The listing is made by tasks, not one folder after another.
    """
    listed = [
        spark.read.format("binaryFile").load(path).select(
            F.col("segment").cast("bigint").alias("segment"),
            F.concat_ws(" ", F.lit(name), F.element_at(F.split("path", "/"), -1), "length", F.unix_millis("modificationTime")).alias("file"),
        )
        for name, path in paths.items()
        if stored_segments(spark, path)
    ]
    if not listed:
        return spark.createDataFrame([], "segment bigint, files string")
    found = listed[0]
    for more in listed[1:]:
        found = found.unionByName(more)
    digest = F.sha2(F.array_join(F.sort_array(F.collect_list("file")), "\n"), 256)
    return found.where("segment is not null").groupBy("segment").agg(digest.alias("files"))


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _fs(spark, path)
    fs.delete(folder, True)


def drop_segments(spark: SparkSession, path: str, segments: Sequence[int]) -> None:
    for segment in segments:
        fs, folder = _fs(spark, f"{path}/segment={segment}")
        fs.delete(folder, True)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table with its declared schema; an absent one reads as empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def hex_columns(df: DataFrame, others: Sequence[str]) -> list[str]:
    """Columns of hex text that aren't among ``others``, the columns compared or ordered by."""
    texts = [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]
    return [name for name in texts if name in HEX and name not in others]


def write_table(
    df: DataFrame, path: str, order: Sequence[str], mode: str = "append", files: int | None = None
) -> None:
    """Write by segment, sorted, so that row groups have narrow number ranges.

    Rows are range partitioned on the full order: a segment, or a block, that holds
    most of the batch is still written by many tasks.
    """
    hexes = hex_columns(df, order)
    rows = packed(df, hexes)
    ordered = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    (
        unpacked(ordered.sortWithinPartitions(*order), hexes)
        .write.mode(mode)
        .option("compression", COMPRESSION)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("segment")
        .parquet(path)
    )


def key_clashes(new: DataFrame, target: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys of ``new`` that the target holds already, or that ``new`` holds twice."""
    keys = [key] if isinstance(key, str) else list(key)
    stored = new.select(*keys).join(target.select(*keys), keys, "left_semi")
    twice = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)
    return stored.unionByName(twice).distinct()


def new_rows(new: DataFrame, target: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet (for re-sent blocks)."""
    keys = [key] if isinstance(key, str) else list(key)
    hexes = hex_columns(new, keys)
    return unpacked(packed(new, hexes).join(target.select(*keys), keys, "left_anti"), hexes)


def append_create_only(
    new: DataFrame,
    path: str,
    schema: T.StructType,
    key: str | Sequence[str],
    order: Sequence[str] = BLOCK_ORDER,
) -> None:
    """Append rows whose keys must all be new. Of the table only the batch's segments are read, and of
    those the row groups that may hold a number between its least and its largest."""
    spark = new.sparkSession
    _finish_replacing(spark, path)
    target = read_table(spark, path, schema)
    touched = [row.segment for row in new.select("segment").distinct().collect()]
    first = key if isinstance(key, str) else key[0]
    ends = new.agg(F.min(first).alias("lo"), F.max(first).alias("hi")).first()
    near = target.where(F.col("segment").isin(touched) & F.col(first).between(ends.lo, ends.hi))
    clashes = key_clashes(new, near, key).limit(5).collect()
    if clashes:
        raise KeyClash(f"already stored: {[row.asDict() for row in clashes]}")
    write_table(new.select(*schema.names), path, order)


def require_contiguous(new: DataFrame, last: int | None, column: str = "block_num") -> None:
    """The batch must have every number from ``last + 1`` (or its own start) on, once."""
    row = new.agg(
        F.count(column).alias("n"),
        F.countDistinct(column).alias("different"),
        F.min(column).alias("lo"),
        F.max(column).alias("hi"),
    ).first()
    if row.n == 0:
        return
    if last is not None and row.lo != last + 1:
        raise NotContiguous(f"Expected: {last + 1} and got {row.lo}")
    if row.different != row.hi - row.lo + 1 or row.n != row.different:
        raise NotContiguous(f"{row.n} blocks between {row.lo} and {row.hi}")


def last_number(spark: SparkSession, path: str, column: str = "block_num") -> int | None:
    """Highest number stored; only the highest segment that holds rows is read."""
    for segment in reversed(stored_segments(spark, path)):
        top = (
            spark.read.parquet(path)
            .where(F.col("segment") == segment)
            .agg(F.max(column).alias("top"))
            .first()
            .top
        )
        if top is not None:
            return top
    return None


def append_blocks(
    blocks: DataFrame,
    txs: DataFrame,
    errors: DataFrame | None,
    folder: str,
    block_schema: T.StructType,
    tx_schema: T.StructType,
    contiguous: bool = True,
) -> tuple[int | None, int | None]:
    """One flush, of rows that are staged first, since they are checked as well as written."""
    with staged(blocks) as new_blocks, staged(txs) as new_txs:
        return append_staged_blocks(new_blocks, new_txs, errors, folder, block_schema, tx_schema, contiguous)


def append_staged_blocks(
    blocks: DataFrame,
    txs: DataFrame,
    errors: DataFrame | None,
    folder: str,
    block_schema: T.StructType,
    tx_schema: T.StructType,
    contiguous: bool = True,
) -> tuple[int | None, int | None]:
    """One flush of stored rows: transactions and errors first, then blocks, so a stored block is whole.

    Returns the write notice (lo, hi).
    """
    if contiguous:
        require_contiguous(blocks, last_number(blocks.sparkSession, f"{folder}/blocks"))
    append_create_only(txs, f"{folder}/transactions", tx_schema, ("block", "trx_index"), TRANSACTION_ORDER)
    if errors is not None:
        write_table(errors, f"{folder}/errors", BLOCK_ORDER)
    append_create_only(blocks, f"{folder}/blocks", block_schema, "block_num", BLOCK_ORDER)
    notice = batch_range(blocks).first()
    return notice.lo, notice.hi


def without_range(df: DataFrame, column: str, lo: int, hi: int | None = None) -> DataFrame:
    """Rows outside ``[lo, hi]``; no ``hi`` means everything from ``lo`` on goes."""
    kept = F.col(column) < lo
    return df.where(kept if hi is None else kept | (F.col(column) > hi))


def _replace_rows(
    spark: SparkSession, path: str, segment: int, column: str, lo: int, hi: int | None, order
) -> None:
    """Delete a number range from one segment by rewriting only the files it touches.

    Files are sorted by number, so a fork near the head touches the newest few. Their
    other rows are written beside the table first; a marker then names the files they
    replace, and from there on the exchange can be finished by any later run.
    """
    rows = spark.read.parquet(path).where(F.col("segment") == segment)
    gone = rows.where(F.col(column) >= lo)
    gone = gone if hi is None else gone.where(F.col(column) <= hi)
    found = [row[0] for row in gone.select("_metadata.file_path").distinct().collect()]
    touched = [_plain(spark, uri) for uri in found]
    if not touched:
        return
    job = f"{path}/{_REPLACE}{uuid.uuid4().hex}"
    kept = without_range(spark.read.parquet(*touched), column, lo, hi)
    keys = [name for name in order if name != "segment"]
    fs, marker = _fs(spark, f"{job}/READY")
    if kept.isEmpty():
        fs.mkdirs(_fs(spark, f"{job}/rows")[1])
    else:
        kept.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(f"{job}/rows")
    out = fs.create(marker, True)
    out.write(bytearray("\n".join([str(segment), *touched]), "utf-8"))
    out.close()
    _finish_replacing(spark, path)


def _plain(spark: SparkSession, uri: str) -> str:
    """The path that an escaped address, as file metadata has it, stands for."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def _finish_replacing(spark: SparkSession, path: str) -> None:
    """Finish marked exchanges of files and forget unmarked ones. Safe to repeat."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return
    for status in fs.listStatus(target):
        job = status.getPath().toString()
        if not status.getPath().getName().startswith(_REPLACE):
            continue
        marker = _fs(spark, f"{job}/READY")[1]
        if fs.exists(marker):
            lines = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(
                fs.open(marker), "utf-8"
            ).split("\n")
            for old in lines[1:]:
                fs.delete(_fs(spark, old)[1], False)
            folder = f"{path}/segment={lines[0]}"
            for part in fs.listStatus(_fs(spark, f"{job}/rows")[1]):
                name = part.getPath().getName()
                if name.endswith(".parquet"):
                    fs.rename(part.getPath(), _fs(spark, f"{folder}/{name}")[1])
            left = _fs(spark, folder)[1]
            if fs.exists(left) and not any(
                part.getPath().getName().endswith(".parquet") for part in fs.listStatus(left)
            ):
                fs.delete(left, True)
        fs.delete(_fs(spark, job)[1], True)


def delete_range(
    spark: SparkSession,
    path: str,
    lo: int,
    hi: int,
    column: str = "block_num",
    shift: int = 0,
    per_segment: int = K.BLOCKS_PER_SEGMENT,
    order: Sequence[str] = BLOCK_ORDER,
) -> None:
    """Delete native blocks ``lo`` to ``hi``, in every segment they touch.

    Segments inside the range are dropped; only the two at its ends are rewritten.
    ``shift`` is native number minus ``column``.
    """
    _finish_replacing(spark, path)
    first, last = lo // per_segment, hi // per_segment
    touched = [segment for segment in stored_segments(spark, path) if first <= segment <= last]
    whole = [
        segment
        for segment in touched
        if lo <= segment * per_segment and (segment + 1) * per_segment - 1 <= hi
    ]
    drop_segments(spark, path, whole)
    for segment in touched:
        if segment not in whole:
            _replace_rows(spark, path, segment, column, lo - shift, hi - shift, order)


def purge_segments_after(
    spark: SparkSession, path: str, number: int, per_segment: int = K.BLOCKS_PER_SEGMENT
) -> list[int]:
    """Drop all segments above the one of ``number``; returns them."""
    beyond = [s for s in stored_segments(spark, path) if s > number // per_segment]
    drop_segments(spark, path, beyond)
    return beyond


def purge_from(
    spark: SparkSession,
    path: str,
    number: int,
    column: str = "block_num",
    shift: int = 0,
    per_segment: int = K.BLOCKS_PER_SEGMENT,
    order: Sequence[str] = BLOCK_ORDER,
) -> None:
    """Delete everything from native block ``number`` on. Repeating it is harmless."""
    _finish_replacing(spark, path)
    purge_segments_after(spark, path, number, per_segment)
    edge = number // per_segment
    if edge in stored_segments(spark, path):
        _replace_rows(spark, path, edge, column, number - shift, None, order)


def purge_chain_from(
    spark: SparkSession, folder: str, number: int, delta: int, per_segment: int = K.BLOCKS_PER_SEGMENT
) -> None:
    """Blocks first, then their transactions, from a native block on."""
    purge_from(spark, f"{folder}/blocks", number, "block_num", 0, per_segment, BLOCK_ORDER)
    purge_from(spark, f"{folder}/transactions", number, "block", delta, per_segment, TRANSACTION_ORDER)


# Trimming before a run and purging at a fork delete the same rows.
trim_from = purge_chain_from


def append_forks(forks: DataFrame, path: str) -> None:
    """Add fork events to the log."""
    forks.write.mode("append").parquet(path)


def load_dump(
    spark: SparkSession,
    dump: DataFrame,
    path: str,
    expected_rows: int,
    order: Sequence[str] = BLOCK_ORDER,
) -> DataFrame:
    """The table, loaded from the dump only if its row count is not the expected one."""
    if not exists(spark, path) or spark.read.parquet(path).count() != expected_rows:
        drop_segments(spark, path, stored_segments(spark, path))
        write_table(dump, path, order)
        loaded = spark.read.parquet(path).count()
        if loaded != expected_rows:
            raise ValueError(f"dump has {loaded} rows, manifest says {expected_rows}")
    return spark.read.parquet(path)
