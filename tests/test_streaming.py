import json
import random
import time

import pytest
from pyspark.sql import functions as F

from golden import SEQUENCES
from ledgerline import schemas as S
from ledgerline.operators import forks, integrity
from ledgerline.sources.feed import read_feed
from ledgerline.streaming import gate, rates, sync
from test_forks import log, replay
from test_translate import accounts, frame, transfer

DELTA = 2


def drain(stream, folder, name, mode="append"):
    query = (
        stream.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint-{name}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.table(name)


def files(df, folder, parts):
    """One file per part, so that each is one micro-batch."""
    for i, part in enumerate(parts):
        df.where(part).coalesce(1).write.mode("append").parquet(folder)


def test_gate_equals_the_batch_form(spark, folder):
    chains = {"a": SEQUENCES["double fork"][0], "b": SEQUENCES["simple fork"][0]}
    df = log(spark, chains["a"], "a").unionAll(log(spark, chains["b"], "b"))
    files(df, folder + "/in", ["arrival_seq < 5", "arrival_seq >= 5"])
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
    verdicts = drain(gate.sequence_gate(source), folder, "gate")
    found = sorted(map(tuple, gate.forks_of(verdicts).collect()))
    batch = forks.fork_events(df, by=["chain_id"])
    expected = batch.select("chain_id", "arrival_seq", "last_non_forked", "last_forked").collect()
    assert found == sorted(map(tuple, expected)) and len(found) == 3
    assert verdicts.where("verdict = 'accepted'").count() == df.count() - 3


def test_gate_drops_jumps_without_moving(spark, folder):
    df = log(spark, [5, 6, 9, 10, 7, 8])
    files(df, folder + "/in", ["true"])
    source = spark.readStream.schema(df.schema).parquet(folder + "/in")
    out = drain(gate.sequence_gate(source, start=5), folder, "jumps").orderBy("arrival_seq").collect()
    assert [r.verdict for r in out] == ["accepted", "accepted", "gap", "gap", "accepted", "accepted"]


def arrivals(spark, numbers, first=0):
    """Actions of arriving blocks: two deposits each; a block sent again has a new id."""
    rows = []
    for i, n in enumerate(numbers, first):
        for k in range(2):
            made = list(transfer(k, block=n, quantity=f"{i + 1}.0000 SYS"))
            made[0], made[2], made[8] = i, f"{i:064x}", f"{i}-{k}"
            rows.append(tuple(made))
    actions = frame(spark, rows)
    return actions.withColumn("block_ts", F.timestamp_seconds(F.col("arrival_seq") + 1_600_000_000))


def contents(spark, folder):
    blocks = spark.read.schema(S.BLOCKS).parquet(folder + "/blocks")
    txs = spark.read.schema(S.TRANSACTIONS).parquet(folder + "/transactions")
    logged = spark.read.schema(S.FORKS).parquet(folder + "/forks")
    return (
        sorted(map(tuple, blocks.select("block_num", "native_hash", "tx_count", "gas_used").collect())),
        sorted(map(tuple, txs.select("block_num", "trx_index", "value_d", "gasusedblock").collect())),
        sorted(map(tuple, logged.select("arrival_seq", "last_non_forked", "last_forked").collect())),
    )


@pytest.mark.parametrize("cuts", [(5,), (3, 8)])
def test_sync_resolves_forks_inside_and_across_batches(spark, folder, cuts):
    numbers = SEQUENCES["double fork"][0]
    stored, events = replay(numbers)
    df = arrivals(spark, numbers)
    bounds = [0, *cuts, len(numbers)]
    parts = [f"arrival_seq >= {a} and arrival_seq < {b}" for a, b in zip(bounds, bounds[1:])]
    files(df, folder + "/in", parts)
    notices = []
    writer = sync.batch_writer(
        accounts(spark),
        folder + "/out",
        DELTA,
        on_write=lambda lo, hi: notices.append((lo, hi)),
        per_segment=4,
        feed_path=folder + "/feed",
    )
    source = spark.readStream.schema(S.ACTIONS).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
    sync.start_sync(source, writer, folder + "/checkpoint").awaitTermination()

    blocks, txs, logged = contents(spark, folder + "/out")
    assert blocks == [(n, f"{i:064x}", 2, 42000) for i, n in stored]
    assert txs == [
        (n, k, f"{i + 1}.0000 SYS", 21000 * (k + 1)) for i, n in stored for k in range(2)
    ]
    assert logged == events
    assert len(notices) == len(parts) and notices[-1][1] == 7
    assert read_feed(spark, folder + "/feed").where("type = 'head'").count() >= len(stored)
    report = integrity.integrity_report(
        spark.read.parquet(folder + "/out/blocks"), spark.read.parquet(folder + "/out/transactions"), DELTA
    )
    integrity.require_clean(report)


def test_replayed_batch_changes_nothing(spark, folder):
    first, second = arrivals(spark, [2, 3, 4, 5]), arrivals(spark, [4, 5, 6], first=4)
    bad = second.withColumn("data", F.col("data").withField("from", F.lit("nobody"))).where("action_seq = 0")
    second = second.where("action_seq = 1").unionAll(bad)
    write = sync.batch_writer(accounts(spark), folder, DELTA, per_segment=4)
    write(first, 0)
    write(second, 1)
    once = contents(spark, folder)
    errors = spark.read.schema(S.ERRORS).parquet(folder + "/errors").count()
    assert once[2] == [(4, 3, 5)] and errors == 3
    write(second, 1)
    assert contents(spark, folder) == once
    assert spark.read.schema(S.ERRORS).parquet(folder + "/errors").count() == errors


def test_stop_block_and_mode():
    assert sync.state_for(950, 1000, True) == sync.HEAD
    assert sync.state_for(850, 1000, True) == sync.SYNC
    assert sync.state_for(950, 1000, False) == sync.SYNC


def test_resent_blocks_are_dropped(spark, folder):
    rows = [(1, "a", 0), (1, "a", 1), (1, "b", 2), (2, "c", 3), (2, "c", 3)]
    df = spark.createDataFrame(rows, "block_num bigint, native_hash string, s bigint")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    df.coalesce(1).write.parquet(folder + "/in")
    source = spark.readStream.schema(df.schema).parquet(folder + "/in")
    got = drain(rates.dedup_stream(source), folder, "resent").collect()
    assert sorted((r.block_num, r.native_hash) for r in got) == [(1, "a"), (1, "b"), (2, "c")]


def test_rates_of_a_stream_equal_those_of_a_batch(spark, folder):
    random.seed(2)
    df = spark.createDataFrame([(i, random.randrange(60)) for i in range(200)], "arrival_seq bigint, s bigint")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    df.coalesce(1).write.parquet(folder + "/in")
    source = spark.readStream.schema(df.schema).parquet(folder + "/in").withWatermark("ts", "1 second")
    stream = drain(rates.arrival_rate(source), folder, "rates", "complete")
    batch = rates.arrival_rate(df)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_activity_sessions_end_where_stalls_begin(spark, folder):
    df = spark.createDataFrame([("a", s) for s in (0, 3, 30, 31, 90)], "chain_id string, s bigint")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    files(df, folder + "/in", ["s < 90", "s >= 90"])
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
    spans = rates.activity_sessions(source.withWatermark("ts", "1 second"), "chain_id", 5)
    got = sorted(map(tuple, drain(spans, folder, "spans").collect()))
    assert got == [("a", 0, 8, 2), ("a", 30, 36, 2)]


def test_stalls_and_eta(spark):
    df = spark.createDataFrame([(0, 0, 5), (1, 3, 6), (2, 30, 7), (3, 31, 8)], "arrival_seq bigint, s bigint, n bigint")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    assert [tuple(r) for r in rates.stalls(df, 5).collect()] == [(2, 3, 27)]
    assert tuple(rates.eta(df, 108, 4.0).first()) == (8, 100, 25.0)
    # Two arrivals in the last ten seconds.
    assert tuple(rates.eta(df, 108).first()) == (8, 100, 500.0)


def test_live_rate_of_batches():
    live = rates.LiveRate(10)
    assert (live.per_second(), live.eta(100), live.stalled_for(5)) == (0.0, (None, None), None)
    live.add(0, 2, 40, 40)
    live.add(2, 4, 60, 90)  # a fork: the highest number is below what came before
    assert live.per_second() == 10.0 and live.eta(190) == (100, 10.0)
    live.add(4, 24, 200, 300)  # half of it lies in the window
    assert live.per_second() == 10.0 and live.last == 300
    live.add(30, 30, 10, 301)
    assert live.per_second() == (200 * 4 / 20 + 10) / 10
    live.add(49, 50, 0, None)
    assert live.per_second() == 0.0 and live.eta(401) == (100, None) and live.stalled_for(55) == 25
    for i in range(1000):
        live.add(60 + i, 61 + i, 1, 400 + i)
    assert len(live._batches) < 20


def test_live_rate_of_a_stream(spark, folder):
    df = spark.createDataFrame([(i, 100 + i) for i in range(20)], "arrival_seq bigint, n bigint")
    files(df, folder + "/in", ["arrival_seq < 15", "arrival_seq >= 15"])
    live = rates.LiveRate(600)
    spark.streams.addListener(live)
    try:
        source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
        stored = drain(rates.observed(source), folder, "observed")
        for _ in range(100):  # events come a little later
            if live.per_second() * 600 > 19.9:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(live)
    assert stored.count() == 20 and live.last == 119
    assert live.per_second() == pytest.approx(20 / 600) and live.eta(219)[0] == 100


def test_resume_point(spark):
    blocks = spark.createDataFrame(
        [(n, f"h{n}", f"h{n - 1}") for n in (10, 11, 12, 15, 16)], "block_num bigint, evm_hash string, evm_prev_hash string"
    ).withColumn("evm_block_num", F.col("block_num") - 2)
    found = integrity.gaps(blocks, "evm_block_num")
    point = lambda *a, **k: tuple(rates.resume_point(*a, **k).first())
    assert point(blocks, found, 2, 36, purge_gaps=True) == (12, "h11", "gap")
    assert point(blocks, found.limit(0), 2, 36) == (16, "h15", "last block")
    assert point(blocks.limit(0), found.limit(0), 2, 36, "abc") == (36, "abc", "configured hash")
    assert point(blocks.limit(0), found.limit(0), 2, 36) == (36, "", "genesis")
    genesis = blocks.limit(1).withColumn("evm_prev_hash", F.lit("0" * 64))
    assert point(genesis, found.limit(0), 2, 36) == (36, "", "genesis")
    with pytest.raises(Exception, match="Gap found in database at 10"):
        point(blocks, found, 2, 36)


def test_feed_is_json(spark, folder):
    write = sync.batch_writer(accounts(spark), folder, DELTA, per_segment=4, feed_path=folder + "/feed")
    write(arrivals(spark, [2, 3]), 0)
    messages = [(row.type, json.loads(row.message)) for row in read_feed(spark, folder + "/feed").collect()]
    assert all(message["type"] == type_ for type_, message in messages)
    stored = {r.hash: r for r in spark.read.schema(S.TRANSACTIONS).parquet(folder + "/transactions").collect()}
    raw = [message["data"] for type_, message in messages if type_ == "raw"]
    assert len(raw) == len(stored) == 4
    for data in raw:
        own = stored[data["@raw"]["hash"]]
        assert data["trx_id"] == own.trx_id and data["@timestamp"].startswith("2020-09-13T12:26:4")
        assert (data["@raw"]["block"], data["@raw"]["trx_index"], data["@raw"]["value"]) == (own.block, own.trx_index, own.value_hex)


def test_windows_whose_slide_does_not_divide_them(spark):
    times = [0, 1, 7, 8, 25]
    df = spark.createDataFrame([(t,) for t in times], "t long").selectExpr("timestamp_seconds(t) as ts")
    for length, step in ((10, 3), (6, 4), (4, 10)):
        got = {r.window_start: r.n for r in rates.arrival_rate(df, f"{length} seconds", f"{step} seconds").collect()}
        starts = {s for t in times for s in range(-100, 100) if s % step == 0 and s <= t < s + length}
        assert got == {s: sum(s <= t < s + length for t in times) for s in starts}


def test_blocks_without_actions_come_from_a_header_table(spark, folder):
    numbers = [2, 3, 4, 5, 6, 7, 6, 7, 8]
    chain = spark.createDataFrame(
        [(i, n, f"{i:064x}") for i, n in enumerate(numbers)], "arrival_seq bigint, block_num bigint, native_hash string"
    ).withColumn("ts", F.timestamp_seconds(F.col("arrival_seq") + 1_600_000_000))
    actions = arrivals(spark, numbers).where("arrival_seq not in (0, 2, 4, 7)")
    write = sync.batch_writer(accounts(spark), folder, DELTA, per_segment=4, headers=sync.headers_from(chain))
    for batch, (low, high) in enumerate([(0, 3), (4, 5), (6, 8), (6, 8)]):
        write(actions.where(F.col("arrival_seq").between(low, high)), min(batch, 2))
    stored, events = replay(numbers)
    blocks, _, logged = contents(spark, folder)
    empty = {0, 2, 4, 7}
    assert blocks == [(n, f"{i:064x}", 0 if i in empty else 2, 0 if i in empty else 42000) for i, n in stored]
    assert logged == events
