"""A ledger folder that grows while it is followed."""

import os
import time

import pytest
from pyspark.sql import functions as F

from golden import SEQUENCES
from ledgerline import schemas as S
from ledgerline.operators import integrity
from ledgerline.sources.ledger import Folder, read_ledger, write_ledger
from ledgerline.streaming import sync
from test_forks import replay
from test_streaming import DELTA, arrivals, contents
from test_translate import accounts


def headers(spark, numbers, first=0, seconds=None):
    rows = [(i, n, f"{i:064x}", (seconds or {}).get(i, i)) for i, n in enumerate(numbers, first)]
    made = spark.createDataFrame(rows, "arrival_seq bigint, block_num bigint, native_hash string, s bigint")
    return made.withColumn("ts", F.timestamp_seconds(F.col("s") + 1_600_000_000))


def add(spark, path, numbers, first=0, empty=(), seconds=None):
    """Blocks arriving in the folder, each of two deposits but for those in ``empty``."""
    made = arrivals(spark, numbers, first).where(~F.col("arrival_seq").isin([-1, *empty]))
    write_ledger(made, headers(spark, numbers, first, seconds), path, 4)


def run(spark, folder, **options):
    query = sync.sync_ledger(
        spark, folder + "/in", accounts(spark), folder + "/out", DELTA, folder + "/checkpoint", mode=sync.SYNC, per_segment=4, **options
    )
    query.awaitTermination()
    assert query.exception() is None


def files_of(folder):
    found = {}
    for root, _, names in os.walk(folder):
        found |= {f"{root}/{n}": os.stat(f"{root}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def numbers_of(spark, folder):
    return sorted(r.block_num for r in spark.read.schema(S.BLOCKS).parquet(folder + "/out/blocks").collect())


def test_batch_reads_push_bounds_and_names_down(spark, folder):
    path = folder + "/in"
    add(spark, path, range(2, 12), empty=[3])
    df = read_ledger(spark, path)
    assert df.where("account is null").count() == 10 and df.where("account is not null").count() == 18
    some = df.where("block_num >= 4 and block_num <= 5 and arrival_seq < 100")
    assert sorted((r.block_num, r.account) for r in some.collect() if r.account is None) == [(4, None), (5, None)]
    named = df.where(F.col("account").isin("eosio.token", "x") & (F.col("name") == "transfer"))
    assert named.count() == 18
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0], plan  # nothing is left for the engine to filter
    read = Folder(path).parts((("block_num", ">=", 4), ("block_num", "<=", 5)))
    assert {p.file.split("segment=")[1][0] for p in read} == {"1"}
    assert all(p.kind == "actions" for p in Folder(path).parts((("account", "==", "x"),)))
    assert read_ledger(spark, folder + "/none").count() == 0


@pytest.mark.parametrize("cuts", [(5,)])
def test_blocks_added_between_batches_with_forks_and_empty_ones(spark, folder, cuts):
    numbers = SEQUENCES["double fork"][0]
    stored, events = replay(numbers)
    bounds = [0, *cuts, len(numbers)]
    empty = {1, 4, 6}
    for a, b in zip(bounds, bounds[1:]):
        add(spark, folder + "/in", numbers[a:b], a, empty)
        run(spark, folder)
    blocks, txs, logged = contents(spark, folder + "/out")
    assert blocks == [(n, f"{i:064x}", 0 if i in empty else 2, 0 if i in empty else 42000) for i, n in stored]
    assert len(txs) == 2 * sum(i not in empty for i, _ in stored)
    assert logged == events
    out = folder + "/out"
    integrity.require_clean(integrity.integrity_report(spark.read.parquet(out + "/blocks"), spark.read.parquet(out + "/transactions"), DELTA))


def test_a_jump_is_dropped_and_logged(spark, folder):
    add(spark, folder + "/in", [2, 3, 7, 4, 5])
    run(spark, folder)
    assert numbers_of(spark, folder) == [2, 3, 4, 5]
    gaps = spark.read.parquet(folder + "/out/gaps")
    assert [(r.arrival_seq, r.n, r.verdict) for r in gaps.collect()] == [(2, 7, "gap")]
    add(spark, folder + "/in", [6, 7, 8], 5)
    run(spark, folder)
    assert numbers_of(spark, folder) == [2, 3, 4, 5, 6, 7, 8]
    gaps = spark.read.parquet(folder + "/out/gaps").orderBy("verdict")
    assert [(r.arrival_seq, r.n, r.verdict) for r in gaps.collect()] == [(2, 7, "gap"), (2, 7, "refilled")]


def test_forks_inside_the_window_touch_no_stored_file(spark, folder):
    """Blocks a second apart, a window of four seconds."""
    add(spark, folder + "/in", range(2, 12))
    run(spark, folder, window=4)
    assert numbers_of(spark, folder) == [2, 3, 4, 5, 6]  # block 11 is five seconds younger than 6
    before = files_of(folder + "/out/blocks")
    add(spark, folder + "/in", [9, 10, 11, 12, 13, 14], 10)
    run(spark, folder, window=4)
    after = files_of(folder + "/out/blocks")
    assert before.items() <= after.items() and len(after) > len(before)
    assert numbers_of(spark, folder) == list(range(2, 10))
    forks = spark.read.schema(S.FORKS).parquet(folder + "/out/forks").collect()
    assert [(r.arrival_seq, r.last_non_forked, r.last_forked) for r in forks] == [(10, 8, 11)]
    hashes = {r.block_num: int(r.native_hash, 16) for r in spark.read.parquet(folder + "/out/blocks").collect()}
    assert hashes == {n: n - 2 for n in range(2, 9)} | {9: 10}  # 9 came again with arrival 10


def test_forks_beyond_the_window_are_late(spark, folder):
    add(spark, folder + "/in", range(2, 12))
    run(spark, folder, window=4)
    add(spark, folder + "/in", [5, 6, 12, 13, 14], 10, seconds={10: 10, 11: 11, 12: 10, 13: 11, 14: 12})
    before = files_of(folder + "/out/blocks")
    run(spark, folder, window=4)
    assert before.items() <= files_of(folder + "/out/blocks").items()
    late = spark.read.parquet(folder + "/out/late").orderBy("arrival_seq").collect()
    assert [(r.arrival_seq, r.n) for r in late] == [(10, 5), (11, 6)]
    assert numbers_of(spark, folder) == list(range(2, 10))
    hashes = {r.block_num: int(r.native_hash, 16) for r in spark.read.parquet(folder + "/out/blocks").collect()}
    assert hashes == {n: n - 2 for n in range(2, 10)}


def test_the_last_block_lets_everything_out(spark, folder):
    add(spark, folder + "/in", range(2, 12))
    run(spark, folder, window=100, stop=9)
    assert numbers_of(spark, folder) == list(range(2, 10))


def test_headers_that_are_not_there_yet_hold_the_offset(spark, folder):
    path = folder + "/in"
    write_ledger(None, headers(spark, [4, 5], 2), path, 4)
    assert Folder(path).through(-1) == -1
    write_ledger(None, headers(spark, [2, 3], 0), path, 4)
    assert Folder(path).through(-1) == 3


def test_near_the_head_the_mode_changes(spark, folder):
    add(spark, folder + "/in", range(2, 8))
    query = sync.sync_ledger(
        spark, folder + "/in", accounts(spark), folder + "/out", DELTA, folder + "/checkpoint", per_segment=4, interval="200 milliseconds"
    )
    try:
        assert query.isActive and numbers_of(spark, folder) == list(range(2, 8))
        add(spark, folder + "/in", [8, 9], 6)
        until = time.time() + 90
        while numbers_of(spark, folder)[-1] < 9 and time.time() < until and query.isActive:
            time.sleep(0.5)
        assert numbers_of(spark, folder) == list(range(2, 10))
    finally:
        query.stop()


def test_a_header_path_is_listed_anew(spark, folder):
    path = folder + "/headers"
    numbers = list(range(2, 7))
    write = sync.batch_writer(accounts(spark), folder + "/out", DELTA, per_segment=4, headers=sync.headers_from(path))
    headers(spark, numbers[:3]).drop("s").write.parquet(path)
    actions = arrivals(spark, numbers)
    write(actions.where("arrival_seq in (0, 2)"), 0)
    headers(spark, numbers[3:], 3).drop("s").write.mode("append").parquet(path)
    write(actions.where("arrival_seq = 4"), 1)
    blocks, _, _ = contents(spark, folder + "/out")
    assert [(b[0], b[2]) for b in blocks] == [(2, 2), (3, 0), (4, 2), (5, 0), (6, 2)]
