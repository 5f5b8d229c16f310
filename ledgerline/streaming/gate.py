"""The sequence gate: which arrivals of a live stream are accepted, and when they are final."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ACCEPTED, GAP, FORK, LATE, REFILLED = "accepted", "gap", "fork", "late", "refilled"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

VERDICTS = T.StructType(
    [
        T.StructField("chain_id", T.StringType()),
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("native_hash", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("final", T.BooleanType()),
        T.StructField("last_non_forked", T.LongType()),
        T.StructField("last_forked", T.LongType()),
    ]
)
#: Last number of the chain, last number that was given out as final, last number of a branch that forks off below it.
ENDS = T.StructType([T.StructField(name, T.LongType()) for name in ("last", "final", "late")])
#: An arrival, its time as microseconds.
HELD = T.StructType(
    [
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("us", T.LongType()),
        T.StructField("native_hash", T.StringType()),
    ]
)


class Chain:
    """What is known of one chain, and the verdicts on its next arrivals."""

    def __init__(self, ends: tuple, jumps: list[tuple], held: list[tuple], window: float | None, stop: int | None):
        self.last, self.final, self.late = ends
        self.jumps, self.held = jumps, held
        self.window, self.stop = window, stop
        self.out: list[tuple] = []

    def _say(self, arrival: tuple, verdict: str, final: bool, non_forked: int | None = None, forked: int | None = None) -> None:
        self.out.append((*arrival, verdict, final, non_forked, forked))

    def arrive(self, arrival: tuple) -> None:
        """The next number, or the first one, is accepted; a jump ahead is dropped; anything else is a fork that starts over."""
        n = arrival[1]
        if self.late is not None and n == self.late + 1:
            self.late = n
            self._say(arrival, LATE, False)
            return
        if self.last is not None and n > self.last + 1:
            self.jumps.append(arrival)
            self._say(arrival, GAP, False)
            return
        fork = self.last is not None and n <= self.last
        if fork and self.window is not None and self.final is not None and n <= self.final:
            self.late = n
            self._say(arrival, LATE, False, n - 1, self.last)
            return
        self.late = None
        verdict = (FORK, n - 1, self.last) if fork else (ACCEPTED, None, None)
        self.last = n
        if self.window is None:
            self.final = n
            self._say(arrival, verdict[0], True, *verdict[1:])
        else:
            if fork:
                self.held = [h for h in self.held if h[1] < n]
                self._say(arrival, FORK, False, *verdict[1:])
            self.held.append(arrival)
        for jump in [j for j in self.jumps if j[1] == n]:
            self._say(jump, REFILLED, False)
        self.jumps = [j for j in self.jumps if j[1] != n]

    def release(self) -> None:
        """Give out what no fork inside the window can reach any more; everything once the last block is there."""
        if not self.held:
            return
        ended = self.stop is not None and self.held[-1][1] == self.stop
        newest = max(h[2] for h in self.held)
        while self.held and (ended or newest - self.held[0][2] > self.window * 1_000_000):
            arrival = self.held.pop(0)
            self.final = arrival[1]
            self._say(arrival, ACCEPTED, True)

    @property
    def ends(self) -> tuple:
        return (self.last, self.final, self.late)


class Gate(StatefulProcessor):
    """State of a chain: its last numbers, jumps that weren't filled yet, and blocks that aren't final yet."""

    def __init__(self, first: int | None, window: float | None, stop: int | None):
        self.first, self.window, self.stop = first, window, stop

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ends = handle.getValueState("ends", ENDS)
        self.jumps = handle.getListState("jumps", HELD)
        self.held = handle.getListState("held", HELD)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrivals = pd.concat(list(rows), ignore_index=True).sort_values("arrival_seq").drop_duplicates("arrival_seq")
        ends = tuple(self.ends.get()) if self.ends.exists() else (self.first, self.first, None)
        had = list(map(tuple, self.jumps.get())), list(map(tuple, self.held.get()))
        chain = Chain(ends, list(had[0]), list(had[1]), self.window, self.stop)
        hashes = [h if isinstance(h, str) else None for h in arrivals["native_hash"].tolist()]
        for arrival in zip(arrivals["arrival_seq"].tolist(), arrivals["n"].tolist(), arrivals["us"].tolist(), hashes, strict=True):
            chain.arrive(arrival)
        chain.release()
        self.ends.update(chain.ends)
        for state, before, now in ((self.jumps, had[0], chain.jumps), (self.held, had[1], chain.held)):
            if now != before:
                state.put(now) if now else state.clear()
        names = ["arrival_seq", "n", "us", "native_hash", "verdict", "final", "last_non_forked", "last_forked"]
        out = pd.DataFrame(chain.out, columns=names)
        out.insert(0, "chain_id", key[0])
        out["ts"] = pd.to_datetime(out.pop("us").astype("int64"), unit="us", utc=True)
        for name in ("last_non_forked", "last_forked"):
            out[name] = out[name].astype("Int64")
        yield out[VERDICTS.names]

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """Keyed state with lists needs this store; it keeps state on disk, so it may outgrow memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def sequence_gate(stream: DataFrame, start: int | None = None, window: float | None = None, stop: int | None = None) -> DataFrame:
    """Verdicts on the arrivals of ``(chain_id, arrival_seq, n)``, and ``ts`` and ``native_hash`` if they are there.

    Without ``window`` every arrival gets its verdict at once, and what is accepted is final. With one (seconds) blocks are held back: they
    come out as accepted once the chain's newest block is that much younger, so a fork inside the window only changes
    the state; one below the last final block is late, and so are the blocks that follow it. ``stop``, the chain's
    last block, lets everything out. A jump ahead is kept in mind until its number arrives in order (``refilled``).

    The decision on an arrival depends on the one before it, so this is serial per chain by nature. It reads one narrow row
    per block, of which a chain makes two a second, and keeps the window's blocks as state; actions never pass
    through it. A backfill uses the window form in ``operators.forks``, which is parallel.
    """
    use_state_store(stream.sparkSession)
    optional = {"ts": "timestamp", "native_hash": "string"}
    given = {c: F.col(c) if c in stream.columns else F.lit(None).cast(kind) for c, kind in optional.items()}
    us = F.coalesce(F.unix_micros(given["ts"]), F.lit(0))
    narrow = stream.select("chain_id", "arrival_seq", "n", us.alias("us"), given["native_hash"].alias("native_hash"))
    gate = Gate(None if start is None else start - 1, window, stop)
    return narrow.groupBy("chain_id").transformWithStateInPandas(gate, VERDICTS, "Append", "None")


def forks_of(verdicts: DataFrame) -> DataFrame:
    """Fork log rows of a gate's output."""
    return verdicts.where(F.col("verdict") == FORK).select(
        "chain_id", "arrival_seq", "last_non_forked", "last_forked"
    )
