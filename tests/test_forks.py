import random

import pytest
from pyspark.sql import functions as F

from golden import SEQUENCES
from ledgerline.operators import forks


def log(spark, numbers, chain="a"):
    return spark.createDataFrame(
        [(chain, i, n) for i, n in enumerate(numbers)], "chain_id string, arrival_seq bigint, n bigint"
    ).withColumn("ts", F.timestamp_seconds(F.col("arrival_seq")))


def replay(numbers):
    """The live rule, one arrival at a time."""
    stored, last, events = [], None, []
    for i, n in enumerate(numbers):
        if last is not None and n <= last[1]:
            events.append((i, n - 1, last[1]))
            stored = [(j, m) for j, m in stored if m < n]
        stored.append((i, n))
        last = (i, n)
    return stored, events


@pytest.mark.parametrize("name", SEQUENCES)
@pytest.mark.parametrize("width", [2, 100_000])
def test_known_sequences(spark, name, width):
    arrivals, canonical, events = SEQUENCES[name]
    df = log(spark, arrivals)
    kept = forks.canonical_chain(df, width=width).orderBy("n").collect()
    assert [r.n for r in kept] == canonical
    found = forks.fork_events(df, width=width).orderBy("arrival_seq").collect()
    assert [(r.last_non_forked, r.last_forked) for r in found] == events
    assert forks.sequence_gaps(df, width=width).count() == 0
    assert forks.discarded(df, width=width).count() == len(arrivals) - len(canonical)


@pytest.mark.parametrize("seed", range(3))
def test_random_chains_match_the_live_rule(spark, seed):
    random.seed(seed)
    chains = {}
    for chain in "ab":
        numbers = [10]
        for _ in range(300):
            last = numbers[-1]
            numbers.append(max(1, last - random.randrange(6)) if random.random() < 0.1 else last + 1)
        chains[chain] = numbers
    df = log(spark, chains["a"], "a").unionAll(log(spark, chains["b"], "b")).repartition(5)
    kept = forks.canonical_chain(df, by=["chain_id"], width=7).collect()
    events = forks.fork_events(df, by=["chain_id"], width=7).collect()
    for chain, numbers in chains.items():
        stored, expected = replay(numbers)
        assert sorted((r.arrival_seq, r.n) for r in kept if r.chain_id == chain) == stored
        assert (
            sorted((r.arrival_seq, r.last_non_forked, r.last_forked) for r in events if r.chain_id == chain)
            == expected
        )


def test_double_forks(spark):
    points = [100, 2000, 2500, 2400, 9000, 9999]
    df = spark.createDataFrame(list(enumerate(points)), "arrival_seq bigint, last_non_forked bigint")
    got = forks.double_forks(df, width=2).orderBy("arrival_seq").collect()
    assert [r.last_non_forked for r in got] == [2500, 2400, 9999]


def test_cleanup_of_unwritten_blocks(spark):
    blocks = spark.range(8, 15).select(F.col("id").alias("block_num"))
    log_rows = spark.createDataFrame([(10, 14)], "last_non_forked bigint, last_forked bigint")
    left = forks.without_discarded(blocks, log_rows).collect()
    assert sorted(r.block_num for r in left) == [8, 9, 10]
    assert forks.without_discarded(blocks, log_rows.limit(0)).count() == 7


def test_old_hash(spark):
    blocks = spark.createDataFrame([(5, "h5"), (6, "h6")], "block_num bigint, evm_hash string")
    df = spark.createDataFrame([(0, 5), (1, 5), (2, 9)], "arrival_seq bigint, last_non_forked bigint")
    got = {r.arrival_seq: r.old_hash for r in forks.old_hashes(df, blocks).collect()}
    assert got == {0: "h5", 1: "h5", 2: None}
