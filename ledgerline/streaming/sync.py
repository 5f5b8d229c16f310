"""Continuous sync: micro-batches of translated blocks into the tables, forks included.

``sync_ledger`` follows a ledger folder: its headers run through the sequence gate, which drops jumps and may hold blocks
back until no fork inside a window can reach them; a batch then fetches the actions of the blocks it was given.
``start_sync`` with ``batch_writer`` takes a stream of actions as it is.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline import schemas as S
from ledgerline.operators.feed import head_feed, in_sending_order
from ledgerline.operators.forks import canonical_chain, fork_events
from ledgerline.operators.totals import assemble_blocks
from ledgerline.operators.translate import translate_actions
from ledgerline.sources import tables
from ledgerline.sources.actions import whitelisted
from ledgerline.sources.feed import send
from ledgerline.sources.ledger import ACTIONS, HEADERS, read_ledger
from ledgerline.streaming import gate, rates

SYNC, HEAD = "sync", "head"
KEPT_NOTES = 8
Headers = Callable[[DataFrame, int | None, int], DataFrame]


def state_for(last: int, target: int, head_is_target: bool, near: int = K.HEAD_DISTANCE) -> str:
    """HEAD when the target is the chain's head and at most ``near`` blocks away."""
    return HEAD if head_is_target and target - last <= near else SYNC


def block_headers(actions: DataFrame, after: int | None = None, through: int | None = None) -> DataFrame:
    """One row per block arrival that has actions, from their rows."""
    return (
        actions.select(
            "arrival_seq",
            "block_num",
            F.col("block_ts").alias("ts"),
            F.col("block_id").alias("native_hash"),
        )
        .distinct()
    )


HEADER = "arrival_seq long, block_num long, ts timestamp, native_hash string"


def headers_from(table: DataFrame | str) -> Headers:
    """Headers out of ``table(arrival_seq, block_num, ts, native_hash)``, blocks without actions included.

    A batch takes the arrivals after those of the batch before it, up to its own last one. A path is listed anew for every
    batch, so that files written meanwhile count; the files of a DataFrame are those of when it was made.
    """

    def headers(actions: DataFrame, after: int | None, through: int) -> DataFrame:
        known = table if isinstance(table, DataFrame) else actions.sparkSession.read.schema(HEADER).parquet(table)
        found = known.where(F.col("arrival_seq") <= through)
        found = found if after is None else found.where(F.col("arrival_seq") > after)
        return found.select("arrival_seq", "block_num", "ts", "native_hash").distinct()

    return headers


class Note(NamedTuple):
    """What was there before a batch first ran: last stored block, last arrival of earlier
    batches, and whether the batch runs again."""

    last: int | None
    after: int | None
    again: bool


def batch_note(spark: SparkSession, folder: str, batch_id: int, through: int) -> Note:
    """The batch's note, written before anything else, so a batch that is replayed after a loss
    does not take its own half-written rows for a stored chain. The last few notes are kept."""
    place = f"{folder}/progress"
    note = f"{place}/batch={batch_id}"
    form = "last long, after long, through long"
    if tables.exists(spark, note):
        row = spark.read.schema(form).parquet(note).first()
        return Note(row.last, row.after, True)
    last, after = tables.last_number(spark, f"{folder}/blocks"), None
    known = tables.numbered_folders(spark, place, "batch=")
    earlier = [number for number in known if number < batch_id]
    if earlier:
        after = spark.read.schema(form).parquet(f"{place}/batch={max(earlier)}").first().through
    spark.createDataFrame([(last, after, through)], form).coalesce(1).write.mode("overwrite").parquet(note)
    for old in earlier:
        if old < batch_id - KEPT_NOTES:
            tables.drop_folder(spark, f"{place}/batch={old}")
    return Note(last, after, False)


def apply_forks(
    arrivals: DataFrame,
    note: Note,
    folder: str,
    delta: int,
    per_segment: int = K.BLOCKS_PER_SEGMENT,
) -> None:
    """Log the forks of a batch of arrivals (arrival_seq, n, ts) and make room for it.

    Everything stored from the batch's lowest number on is purged: it was forked away,
    or an earlier attempt at this batch wrote it.
    """
    spark = arrivals.sparkSession
    last, again = note.last, note.again
    ends = arrivals.agg(F.min("n").alias("n"), F.min("arrival_seq").alias("first")).first()
    lowest = ends.n
    log = fork_events(arrivals).select(*S.FORKS.names)
    if last is not None:
        # The first arrival has no other before it in the batch, only the stored chain.
        first = arrivals.orderBy("arrival_seq").limit(1).where(F.col("n") <= last)
        log = log.unionByName(
            first.select(
                "ts",
                (F.col("n") - 1).alias("last_non_forked"),
                F.lit(last).cast("bigint").alias("last_forked"),
                "arrival_seq",
            )
        )
    if tables.exists(spark, f"{folder}/forks"):
        known = spark.read.schema(S.FORKS).parquet(f"{folder}/forks")
        known = known.where(F.col("arrival_seq") >= ends.first).select("arrival_seq")
        log = log.join(known, "arrival_seq", "left_anti").select(*S.FORKS.names)
    tables.append_forks(log, f"{folder}/forks")
    if again or (last is not None and lowest <= last):
        tables.purge_chain_from(spark, folder, lowest, delta, per_segment)
    if again:
        tables.purge_from(spark, f"{folder}/errors", lowest, per_segment=per_segment)


def batch_writer(
    accounts: DataFrame,
    folder: str,
    delta: int,
    on_write: Callable[[int | None, int | None], None] | None = None,
    per_segment: int = K.BLOCKS_PER_SEGMENT,
    feed_path: str | None = None,
    headers: Headers = block_headers,
):
    """A ``foreachBatch`` function: actions in; blocks, transactions, errors, forks out.

    ``headers`` tells the blocks of a batch: without a block table those that have actions,
    with ``headers_from`` all. Arrivals that a later one of the same batch forks away never get translated.
    Running a batch again gives the same tables as running it once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with tables.staged(batch) as actions:
            through = actions.agg(F.max("arrival_seq").alias("through")).first().through
            if through is None:
                return
            note = batch_note(batch.sparkSession, folder, batch_id, through)
            arrived = headers(actions, note.after, through)
            _store(arrived, actions, accounts, note, batch_id, folder, delta, per_segment, feed_path, on_write)

    return write


def _store(
    arrived: DataFrame,
    actions: DataFrame,
    accounts: DataFrame,
    note: Note,
    batch_id: int,
    folder: str,
    delta: int,
    per_segment: int,
    feed_path: str | None,
    on_write: Callable[[int | None, int | None], None] | None,
) -> None:
    """Translate the blocks of a batch that no later one of it forks away, and write them."""
    with contextlib.ExitStack() as stack:
        arrived = stack.enter_context(tables.staged(arrived))
        arrivals = arrived.select("arrival_seq", F.col("block_num").alias("n"), "ts")
        kept = canonical_chain(arrivals).select("arrival_seq")
        survivors = actions.join(kept, "arrival_seq", "left_semi")
        txs, errors = translate_actions(survivors, accounts, delta, per_segment=per_segment)
        new_txs = stack.enter_context(tables.staged(txs))
        blocks = assemble_blocks(
            arrived.join(kept, "arrival_seq", "left_semi"),
            new_txs,
            delta,
            F.col("raw_size"),
            per_segment,
        )
        blocks = stack.enter_context(tables.staged(blocks))
        apply_forks(arrivals, note, folder, delta, per_segment)
        notice = tables.append_staged_blocks(blocks, new_txs, errors, folder, S.BLOCKS, S.TRANSACTIONS, contiguous=True)
        if feed_path is not None:
            feed = head_feed(blocks, new_txs.select(*S.TRANSACTIONS.names), documents=True)
            send(in_sending_order(feed), feed_path, batch_id)
    if on_write is not None:
        on_write(*notice)


def ledger_writer(
    path: str,
    accounts: DataFrame,
    folder: str,
    delta: int,
    on_write: Callable[[int | None, int | None], None] | None = None,
    per_segment: int = K.BLOCKS_PER_SEGMENT,
    feed_path: str | None = None,
    whitelist: dict[str, list[str]] | None = None,
):
    """A ``foreachBatch`` function: the gate's verdicts in; blocks, transactions, errors, forks, gaps and late blocks out.

    Blocks that are final get the actions that the ledger folder ``path`` holds for them. Dropped jumps (and later their
    refilling) go to ``gaps``, blocks of forks below the last final block to ``late``, one folder a batch, so that
    a batch that runs again replaces its own rows. Messages go to the feed at ``feed_path`` once a batch, under the number that the
    checkpoint gives it: a new checkpoint needs a new feed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with tables.staged(batch) as verdicts:
            seen = verdicts.agg(
                F.min(F.when(F.col("final"), F.col("arrival_seq"))).alias("least"),
                F.max(F.when(F.col("final"), F.col("arrival_seq"))).alias("largest"),
                *[F.count(F.when(F.col("verdict").isin(*kinds), 1)).alias(name) for name, kinds in LOGS.items()],
            ).first()
            for name, kinds in LOGS.items():
                if seen[name]:
                    log = verdicts.where(F.col("verdict").isin(*kinds)).select("chain_id", "arrival_seq", "n", "ts", "native_hash", "verdict")
                    log.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")
            _log_forks(verdicts.where((F.col("verdict") == gate.FORK) & ~F.col("final")), folder)
            if seen.largest is None:
                return
            note = batch_note(spark, folder, batch_id, seen.largest)
            final = verdicts.where("final").select("arrival_seq", F.col("n").alias("block_num"), "ts", "native_hash")
            actions = read_ledger(spark, path, rows=ACTIONS).where(F.col("arrival_seq").between(seen.least, seen.largest))
            actions = actions.where(whitelisted(whitelist)).join(final.select("arrival_seq"), "arrival_seq", "left_semi").select(*S.ACTIONS.names)
            with tables.staged(actions) as own:
                _store(final, own, accounts, note, batch_id, folder, delta, per_segment, feed_path, on_write)

    return write


#: Verdicts that are logged beside the tables.
LOGS = {"gaps": (gate.GAP, gate.REFILLED), "late": (gate.LATE,)}


def _log_forks(forks: DataFrame, folder: str) -> None:
    """Add forks that the gate resolved by itself to the log, each once."""
    rows = forks.select("ts", "last_non_forked", "last_forked", "arrival_seq")
    least = rows.agg(F.min("arrival_seq").alias("least")).first().least
    if least is None:
        return
    if tables.exists(forks.sparkSession, f"{folder}/forks"):
        known = forks.sparkSession.read.schema(S.FORKS).parquet(f"{folder}/forks").where(F.col("arrival_seq") >= least)
        rows = rows.join(known.select("arrival_seq"), "arrival_seq", "left_anti").select(*S.FORKS.names)
    tables.append_forks(rows, f"{folder}/forks")


def sync_ledger(
    spark: SparkSession,
    path: str,
    accounts: DataFrame,
    folder: str,
    delta: int,
    checkpoint: str,
    window: float | None = None,
    start: int | None = None,
    stop: int | None = None,
    mode: str | None = None,
    interval: str = "1 second",
    rate: rates.LiveRate | None = None,
    **options,
):
    """Follow a ledger folder into the tables of ``folder``; returns the running query.

    ``window`` (seconds) is how far back a reorganisation may reach: younger blocks are held back, so that forks inside it touch no stored
    file. Without one a fork purges what was stored. ``mode`` None picks SYNC until the stored chain is near the
    ledger's head and HEAD from then on; a run in SYNC mode ends with what is there. ``rate`` learns how many
    arrivals pass, and the highest. ``options`` go to ``ledger_writer``.
    """
    heads = read_ledger(spark, path, stream=True, rows=HEADERS, start=start, stop=stop)
    arrivals = heads.select(
        F.lit("").alias("chain_id"), "arrival_seq", F.col("block_num").alias("n"), F.col("block_ts").alias("ts"), F.col("block_id").alias("native_hash")
    )
    if rate is not None:
        spark.streams.addListener(rate)
        arrivals = rates.observed(arrivals)
    verdicts = gate.sequence_gate(arrivals, start, window, stop)
    write = ledger_writer(path, accounts, folder, delta, **options)
    if mode is not None:
        return start_sync(verdicts, write, checkpoint, mode, interval=interval)
    before = -1
    while True:
        head = read_ledger(spark, path, rows=HEADERS, stop=stop).agg(F.max("block_num").alias("head")).first().head
        last = tables.last_number(spark, f"{folder}/blocks")
        near = last is not None and head is not None and state_for(last, head, True) == HEAD
        if near or head == before:  # or nothing new to catch up with: what is missing is held back
            return start_sync(verdicts, write, checkpoint, HEAD, interval=interval)
        before = head
        start_sync(verdicts, write, checkpoint, SYNC).awaitTermination()


def start_sync(
    stream: DataFrame,
    writer: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = SYNC,
    stop: int | None = None,
    interval: str = "1 second",
):
    """Start the query. SYNC takes what is there in bounded batches and ends; HEAD
    keeps writing as blocks arrive. ``stop`` is the last block to take."""
    if stop is not None and stop > 0:
        stream = stream.where(F.col("block_num") <= stop)
    query = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    query = query.trigger(availableNow=True) if mode == SYNC else query.trigger(processingTime=interval)
    return query.start()
