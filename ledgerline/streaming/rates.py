"""Throughput, stalls, distance to the target, and where to resume."""

from __future__ import annotations

import math
import threading
from collections import deque
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ledgerline import constants as K
from ledgerline.operators.ordered import neighbours

#: Seconds over which a rate is averaged.
RATE_SECONDS = 10


def _seconds(text: str) -> int:
    amount, unit = text.split()
    return int(amount) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def arrival_rate(df: DataFrame, window: str = "10 seconds", slide: str = "1 second", ts: str = "ts") -> DataFrame:
    """Moving average of arrivals per second over sliding windows.

    A batch is counted per slot first (the common divisor of both) and only those counts are spread over the
    windows they belong to. A stream uses the sliding window of the engine, so it
    needs a watermark on ``ts``.
    """
    length, step = _seconds(window), _seconds(slide)
    if df.isStreaming:
        counted = df.groupBy(F.window(ts, window, slide)).agg(F.count(F.lit(1)).alias("n"))
        start = F.unix_seconds(F.col("window.start"))
        return counted.select(start.alias("window_start"), "n", (F.col("n") / length).alias("per_second"))
    unit = math.gcd(length, step)
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    slots = df.groupBy((second - F.pmod(second, F.lit(unit))).alias("slot")).agg(
        F.count(F.lit(1)).alias("slot_rows")
    )
    # Windows begin at multiples of the slide; those of a slot begin after slot - length.
    lowest = F.col("slot") - F.lit(length - unit)
    first, last = lowest + F.pmod(-lowest, F.lit(step)), F.col("slot") - F.pmod(F.col("slot"), F.lit(step))
    starts = F.when(first <= last, F.sequence(first, F.greatest(first, last), F.lit(step).cast("bigint")))
    return (
        slots.withColumn("window_start", F.explode(starts))
        .groupBy("window_start")
        .agg(F.sum("slot_rows").alias("n"))
        .select("window_start", "n", (F.col("n") / length).alias("per_second"))
    )


def stalls(df: DataFrame, seconds: int, position: str = "arrival_seq", ts: str = "ts") -> DataFrame:
    """Times without any arrival for more than ``seconds``, between two arrivals."""
    stamped = df.select(position, F.unix_seconds(F.col(ts).cast("timestamp")).alias("at"))
    linked = neighbours(stamped, position, {"prev_at": "at"})
    return linked.where(F.col("at") - F.col("prev_at") > seconds).select(
        position, F.col("prev_at").alias("stalled_from"), (F.col("at") - F.col("prev_at")).alias("stalled_for")
    )


def activity_sessions(stream: DataFrame, chain: str, seconds: int, ts: str = "ts") -> DataFrame:
    """Streaming form: spans of arrivals per chain; a stall lies between one and the next."""
    return (
        stream.groupBy(chain, F.session_window(ts, f"{seconds} seconds"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            chain,
            F.unix_seconds(F.col("session_window.start")).alias("active_from"),
            F.unix_seconds(F.col("session_window.end")).alias("quiet_at"),
            "n",
        )
    )


def eta(df: DataFrame, target: int, per_second: float | None = None, column: str = "n", ts: str = "ts") -> DataFrame:
    """Blocks left to the target and the seconds they take at the measured rate.

    Without a given rate that of the last ten seconds before the newest arrival counts.
    """
    if per_second is not None:
        top = df.agg(F.max(column).alias("last"))
        rate = F.lit(float(per_second))
    else:
        # One scan: arrivals per second; the newest ten seconds and the highest number are eleven rows at most.
        at = F.unix_seconds(F.col(ts).cast("timestamp"))
        counted = df.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("rows"), F.max(column).alias("last"))
        highest = counted.agg(F.max("last").alias("last"))
        latest = counted.where("at is not null").orderBy(F.desc("at")).limit(RATE_SECONDS)
        few = latest.select("at", "rows").unionByName(highest, allowMissingColumns=True)
        top = few.agg(F.max("last").alias("last"), F.max("at").alias("newest"), F.collect_list(F.struct("at", "rows")).alias("each"))
        recent = F.filter("each", lambda x: x["at"] > F.col("newest") - RATE_SECONDS)
        rate = F.aggregate(recent, F.lit(0).cast("bigint"), lambda total, x: total + x["rows"]) / RATE_SECONDS
    left = F.lit(target) - F.col("last")
    return top.select(
        "last", left.alias("blocks_left"), F.when(rate > 0, left / rate).alias("eta_seconds")
    )


OBSERVED = "ledger_rate"


def observed(df: DataFrame, column: str = "n") -> DataFrame:
    """``df`` whose rows are counted on their way: no scan of its own."""
    return df.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), F.max(column).alias("last"))


class LiveRate(StreamingQueryListener):
    """Rate, distance to a target and stalls of a running stream, from the counts that ``observed`` adds to it.

    Each batch counts its rows evenly over the time it took. The rate is the average of the last ``seconds``; older batches
    are forgotten, so what is kept doesn't grow. ``spark.streams.addListener(rate)`` starts it.
    """

    def __init__(self, seconds: float = RATE_SECONDS):
        self.seconds = seconds
        self.last: int | None = None
        self._batches: deque[tuple[float, float, int]] = deque()
        self._seen: float | None = None
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(OBSERVED)
        if found is None:
            return
        began = datetime.fromisoformat(event.progress.timestamp.replace("Z", "+00:00")).timestamp()
        self.add(began, began + event.progress.batchDuration / 1000, found.rows, found.last)

    def add(self, began: float, ended: float, rows: int, last: int | None) -> None:
        """A batch of ``rows`` rows, and the highest number among them."""
        with self._lock:
            if rows:
                self.last = last if self.last is None else max(self.last, last)
                self._batches.append((began, ended, rows))
            self._seen = ended if self._seen is None else max(self._seen, ended)
            while self._batches and self._batches[0][1] < self._seen - self.seconds and len(self._batches) > 1:
                self._batches.popleft()

    def per_second(self) -> float:
        """Rows per second over the window that ends with the newest batch, an empty one included."""
        with self._lock:
            if self._seen is None:
                return 0.0
            floor, total = self._seen - self.seconds, 0.0
            for began, ended, rows in self._batches:
                if ended > began:
                    total += rows * max(0.0, ended - max(began, floor)) / (ended - began)
                elif ended > floor:
                    total += rows
            return total / self.seconds

    def eta(self, target: int) -> tuple[int | None, float | None]:
        """Blocks left to ``target`` and the seconds they take; None where nothing arrived, or nothing lately."""
        if self.last is None:
            return None, None
        left, rate = target - self.last, self.per_second()
        return left, (left / rate if rate > 0 else None)

    def stalled_for(self, now: float) -> float | None:
        """Seconds since the last batch that held rows."""
        with self._lock:
            return now - self._batches[-1][1] if self._batches else None


def resume_point(
    blocks: DataFrame,
    gaps: DataFrame,
    delta: int,
    start_block: int,
    prev_hash: str = "",
    purge_gaps: bool = False,
) -> DataFrame:
    """Where a run starts: one row (start_block, prev_hash, source).

    A gap, if purging is allowed, resumes at the last good block before it; otherwise
    a stored chain resumes at its last block, which is fetched again. An empty or
    genesis-only table starts from the configured hash or from genesis.
    """
    last = blocks.agg(
        F.max("block_num").alias("last"), F.max_by("evm_prev_hash", "block_num").alias("last_parent")
    )
    first_gap = gaps.agg(F.min("last_before").alias("gap"))
    one = last.unionByName(first_gap, allowMissingColumns=True).agg(
        F.max("last").alias("last"), F.max("last_parent").alias("last_parent"), F.max("gap").alias("gap")
    )
    resumable = F.col("last").isNotNull() & ~F.col("last_parent").isin(K.ZERO_HASH, K.ZERO_HASH[2:])
    has_gap = F.col("gap").isNotNull()
    if purge_gaps:
        from_gap = F.col("gap") + delta
    else:
        from_gap = F.raise_error(
            F.concat(F.lit("Gap found in database at "), F.col("gap").cast("string"))
        ).cast("bigint")
    picked = one.select(
        F.when(resumable & has_gap, from_gap)
        .when(resumable, F.col("last"))
        .otherwise(F.lit(start_block))
        .cast("bigint")
        .alias("start_block"),
        F.when(resumable & has_gap, "gap")
        .when(resumable, "last block")
        .when(F.lit(prev_hash != ""), "configured hash")
        .otherwise("genesis")
        .alias("source"),
    )
    parents = blocks.select((F.col("block_num") + 1).alias("start_block"), F.col("evm_hash").alias("_parent"))
    stored = F.col("source").isin("gap", "last block")
    # The one picked row goes to the blocks, not the blocks to it.
    parent = parents.join(F.broadcast(picked.select("start_block")), "start_block")
    return picked.join(parent, "start_block", "left").select(
        "start_block",
        F.when(stored, F.coalesce(F.col("_parent"), F.lit("")))
        .otherwise(F.lit(prev_hash))
        .alias("prev_hash"),
        "source",
    )


def with_history(stream: DataFrame, window: str = K.HISTORY_WINDOW, ts: str = "ts") -> DataFrame:
    """How far back a reorganisation may reach; older rows count as late."""
    return stream.withWatermark(ts, window)


def dedup_stream(stream: DataFrame, window: str = K.HISTORY_WINDOW, ts: str = "ts") -> DataFrame:
    """Drops blocks that are sent again within the history window."""
    return with_history(stream, window, ts).dropDuplicatesWithinWatermark(["block_num", "native_hash"])
