"""Whole jobs over a folder of tables: check, repair, find the start, reindex."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline import schemas as S
from ledgerline.operators import summaries
from ledgerline.operators.integrity import first_gap, integrity_report
from ledgerline.operators.scans import in_range
from ledgerline.operators.totals import reindex_blocks
from ledgerline.sources import tables
from ledgerline.streaming.rates import resume_point


class StartPoint:
    """Block to start from, hash of the block before it, and why."""

    def __init__(self, block: int, prev_hash: str, source: str):
        self.block, self.prev_hash, self.source = block, prev_hash, source


def read_chain(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return (
        tables.read_table(spark, f"{folder}/blocks", S.BLOCKS),
        tables.read_table(spark, f"{folder}/transactions", S.TRANSACTIONS),
    )


def check(spark: SparkSession, folder: str, delta: int) -> DataFrame:
    """Findings of the full integrity check of a folder."""
    return integrity_report(*read_chain(spark, folder), delta)


SUMMARIES = "segment_summaries"
#: Batches of summaries that may lie side by side; one more, and all are written anew as one.
SUMMARY_BATCHES = 16


def check_changed(spark: SparkSession, folder: str, delta: int) -> tuple[DataFrame, list[int]]:
    """Findings of the full check, and the segments that were read for them.

    Summaries lie beside the tables, one folder a table and batch, however many segments a batch holds. A segment is
    summarised again if its files are others than those its summary was made of; what counts is its last note, which for
    a dropped segment names no files. A lost run leaves old or no summaries, never wrong ones, as the notes of a batch
    are written last.
    """
    blocks, txs = read_chain(spark, folder)
    place = f"{folder}/{SUMMARIES}"
    now = tables.segment_files(spark, {name: f"{folder}/{name}" for name in ("blocks", "transactions")})
    known = _current(spark, place).withColumnRenamed("files", "known")
    both = now.join(known, "segment", "full").select("segment", "files", "known").where("not files <=> known")
    differing = {row.segment: row.files for row in both.collect()}
    changed = sorted(s for s, files in differing.items() if files is not None)
    if differing:
        _add_batch(spark, place, blocks, txs, differing, delta)
    current = _current(spark, place).where("files is not null")
    stored = {name: _summary(spark, place, name, current) for name in FORMS}
    doubtful = summaries.suspects(stored[summaries.MARKS])
    places = sorted(row.segment for row in doubtful.select("segment").distinct().collect())
    held = txs.where(F.col("segment").isin(places)) if len(places) < current.count() else txs
    held = held.withColumn("mark", F.xxhash64("hash")).join(doubtful.select("mark").distinct(), "mark", "left_semi")
    return summaries.report(stored, held, delta), sorted({*changed, *places})


def _add_batch(
    spark: SparkSession, place: str, blocks: DataFrame, txs: DataFrame, differing: dict[int, str | None], delta: int
) -> None:
    """Summaries of the segments that changed, as one more batch; with those of all others if there are too many batches.

    The few columns of blocks that summaries need are staged: they are read once for several tables.
    """
    changed = [s for s, files in differing.items() if files is not None]
    own = F.col("segment").isin(changed)
    batches = {name: tables.numbered_folders(spark, f"{place}/{name}", "batch=") for name in (*FORMS, NOTED)}
    batch = max((n for found in batches.values() for n in found), default=-1) + 1
    merged = len(batches[NOTED]) >= SUMMARY_BATCHES
    notes = spark.createDataFrame([(files, s) for s, files in differing.items()], NOTES)
    old = _current(spark, place).join(notes, "segment", "left_anti") if merged else None
    with tables.staged(blocks.where(own).select("segment", "block_num", "evm_block_num")) as numbers:
        for name, rows in summaries.summarise(numbers, txs.where(own), delta).items():
            rows = rows.select(*FORMS[name].names)
            if merged:
                rows = rows.unionByName(_summary(spark, place, name, old))
            rows.write.mode("overwrite").parquet(f"{place}/{name}/batch={batch}")
    if merged:
        notes = notes.where("files is not null").unionByName(old.select("files", "segment"))
    notes.coalesce(1).write.mode("overwrite").parquet(f"{place}/{NOTED}/batch={batch}")
    if merged:
        for name, found in batches.items():
            for n in found:
                tables.drop_folder(spark, f"{place}/{name}/batch={n}")


def _batched(spark: SparkSession, place: str, name: str, form: S.T.StructType) -> DataFrame:
    return tables.read_table(spark, f"{place}/{name}", S.T.StructType([*form.fields, S.T.StructField("batch", S.T.LongType())]))


def _current(spark: SparkSession, place: str) -> DataFrame:
    """``(segment, batch, files)`` of each segment's last note."""
    last = F.max_by(F.struct("batch", "files"), "batch").alias("last")
    notes = _batched(spark, place, NOTED, NOTES).groupBy("segment").agg(last)
    return notes.select("segment", "last.batch", "last.files")


def _summary(spark: SparkSession, place: str, name: str, current: DataFrame) -> DataFrame:
    """Rows of one table of the summaries, of the batch that counts for their segment."""
    form = FORMS[name]
    rows = _batched(spark, place, name, form).join(current.select("segment", "batch"), ["segment", "batch"], "left_semi")
    return rows.select(*form.names)


NOTED = "notes"
NOTES = S.T.StructType([S.T.StructField("files", S.T.StringType()), S.T.StructField("segment", S.T.LongType())])


def _form(*names: str):
    return S.T.StructType([S.T.StructField(name, S.T.LongType()) for name in (*names, "segment")])


FORMS = {
    summaries.RUNS: _form("lo", "hi"),
    summaries.EXTRA: _form("evm_block_num", "more"),
    summaries.DELTA: _form("block_num", "evm_block_num", "found_delta"),
    summaries.MARKS: _form("mark", "n"),
    summaries.SEGMENTS: _form("n"),
}


def start_point(
    spark: SparkSession,
    folder: str,
    delta: int,
    start_block: int,
    prev_hash: str = "",
    trim: int | None = None,
    skip_check: bool = False,
    purge_gaps: bool = False,
    per_segment: int = K.BLOCKS_PER_SEGMENT,
) -> StartPoint:
    """Bring a folder into a state a sync can continue from, and say where.

    Trims if asked, raises on wrong numbers or duplicates, repairs the first gap by
    purging from it (only with ``purge_gaps``, else it raises), and purges the last
    block, which is fetched again.
    """
    if trim is not None:
        tables.trim_from(spark, folder, trim, delta, per_segment)
    blocks, txs = read_chain(spark, folder)
    found = first_gap(blocks.limit(0), "evm_block_num")
    if not skip_check:
        report = integrity_report(blocks, txs, delta)
        wrong = report.where(F.col("check").isin("number_delta", "duplicate_block", "duplicate_tx"))
        first = wrong.limit(1).collect()
        if first:
            raise ValueError(f"integrity check failed: {first[0].check} {first[0].key} {first[0].detail}")
        found = first_gap(blocks, "evm_block_num")
    point = resume_point(blocks, found, delta, start_block, prev_hash, purge_gaps).first()
    if point.source in ("gap", "last block"):
        tables.purge_chain_from(spark, folder, point.start_block, delta, per_segment)
    return StartPoint(point.start_block, point.prev_hash, point.source)


def reindex(
    spark: SparkSession,
    source: str,
    target: str,
    delta: int,
    lo: int | None = None,
    hi: int | None = None,
    validate_hash: str = "",
    per_segment: int = K.BLOCKS_PER_SEGMENT,
) -> tuple[int | None, int | None]:
    """Write a range of a chain anew into ``target``; returns the write notice.

    An interrupted run goes on after the target's last block. The first hash written
    by a fresh run has to be ``validate_hash`` if one is given.
    """
    last = tables.last_number(spark, f"{target}/blocks")
    if last is not None:
        lo = last + 1
    blocks, txs = read_chain(spark, source)
    new_blocks, new_txs = reindex_blocks(blocks, txs, delta, lo, hi, per_segment)
    if validate_hash and last is None:
        wanted = in_range(blocks, "block_num", lo, hi, per_segment)
        first = wanted.select("block_num", "evm_hash").orderBy("block_num").limit(1).first()
        if first is not None and first.evm_hash != validate_hash:
            raise ValueError(
                f"initial hash validation failed: got {first.evm_hash} and expected {validate_hash}"
            )
    return tables.append_blocks(
        new_blocks.select(*S.BLOCKS.names),
        new_txs.select(*S.TRANSACTIONS.names),
        None,
        target,
        S.BLOCKS,
        S.TRANSACTIONS,
    )
