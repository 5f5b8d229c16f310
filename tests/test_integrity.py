import random

import pytest
from pyspark.sql import functions as F

from golden import GAP_RANGES
from ledgerline.operators import compare, integrity, scans


def numbers(spark, ranges, delta=36):
    values = [n for lo, hi in ranges for n in range(lo, hi + 1)]
    return spark.createDataFrame([(n,) for n in values], "evm_block_num bigint").withColumn(
        "block_num", F.col("evm_block_num") + delta
    )


@pytest.mark.parametrize("ranges, last_before", GAP_RANGES)
def test_first_gap_of_known_ranges(spark, ranges, last_before):
    row = integrity.first_gap(numbers(spark, ranges), "evm_block_num").first()
    assert (row.last_before, row.first_missing, row.first_after) == (last_before, last_before + 1, ranges[1][0])


@pytest.mark.parametrize("width", [4, 50])
def test_all_gaps_match_brute_force(spark, width):
    random.seed(width)
    values = random.sample(range(1000), 700) * 2
    df = spark.createDataFrame([(v,) for v in values], "n bigint").repartition(6)
    got = sorted(map(tuple, integrity.gaps(df, "n", width).collect()))
    present = sorted(set(values))
    assert got == [(a, a + 1, b, b - a - 1) for a, b in zip(present, present[1:]) if b - a > 1]


def test_no_gap_in_one_block(spark):
    assert integrity.gaps(numbers(spark, [(5, 5)]), "evm_block_num").count() == 0


def test_duplicate_blocks_of_known_ranges(spark):
    first = integrity.duplicates(numbers(spark, [(1, 2), (2, 10)]), "evm_block_num")
    assert [tuple(r) for r in first.collect()] == [(2, 2)]
    second = integrity.duplicates(numbers(spark, [(1, 200), (150, 300)]), "evm_block_num")
    assert sorted(r.evm_block_num for r in second.collect()) == list(range(150, 201))


def test_duplicate_transaction_hash(spark):
    txs = spark.createDataFrame([(n, f"h{n}") for n in range(110, 121)], "block bigint, hash string")
    txs = txs.withColumn("hash", F.when(F.col("block") == 115, "h110").otherwise(F.col("hash")))
    assert [tuple(r) for r in integrity.duplicates(txs, "hash").collect()] == [("h110", 2)]
    assert integrity.duplicates(txs, "hash", 111, 120, "block").count() == 0


def test_histogram_keeps_empty_buckets(spark):
    got = integrity.block_histogram(numbers(spark, [(1, 5), (31, 39)]), "evm_block_num", 10)
    assert sorted(map(tuple, got.collect())) == [
        (0, 5, 1, 5, True),
        (10, 0, None, None, False),
        (20, 0, None, None, False),
        (30, 9, 31, 39, True),
    ]


def test_missing_segments(spark):
    df = spark.createDataFrame([(s,) for s in (0, 1, 1, 4, 5, 9)], "segment bigint")
    assert sorted(map(tuple, scans.segment_gaps(df).collect())) == [(1, 4), (5, 9)]


def chain(spark, n, broken=()):
    rows = [
        (i, i - 36, f"h{i}", f"x{i}" if i in broken else f"h{i - 1}", i // 100) for i in range(100, 100 + n)
    ]
    return spark.createDataFrame(
        rows, "block_num bigint, evm_block_num bigint, evm_hash string, evm_prev_hash string, segment bigint"
    )


def test_parent_links(spark):
    blocks = chain(spark, 50, broken={100, 120})
    # Block 100 has no stored parent, so nothing can be said about its link.
    got = integrity.parent_link_breaks(blocks.unionAll(blocks)).collect()
    assert [tuple(r) for r in got] == [(120, "x120", "h119")]


@pytest.mark.parametrize("width", [3, 10])
def test_fork_neighbourhoods_match_brute_force(spark, width):
    random.seed(width)
    broken = set(random.sample(range(101, 400), 12))
    blocks = chain(spark, 300, broken)
    points = [random.randrange(90, 410) for _ in range(40)] + [200] * 5
    forks = spark.createDataFrame(list(enumerate(points)), "arrival_seq bigint, last_non_forked bigint")
    got = {r.arrival_seq: (r.ok, r.breaks, r.message) for r in integrity.fork_neighbourhood_check(forks, blocks, width).collect()}
    for i, point in enumerate(points):
        inside = sorted(b for b in broken if point - width < b <= point + width and b > 100)
        assert got[i][:2] == (not inside, len(inside))
        if inside:
            assert got[i][2] == f"Mismatch at block {inside[0]}: x{inside[0]} != h{inside[0] - 1}"


def test_integrity_report(spark):
    blocks = chain(spark, 20).where("block_num not in (105, 106)")
    txs = spark.createDataFrame([("a",), ("b",), ("a",)], "hash string")
    report = integrity.integrity_report(blocks.unionAll(blocks.where("block_num = 103")), txs, 36)
    assert sorted(map(tuple, report.collect())) == [
        ("duplicate_block", "67", "copies 2"),
        ("duplicate_tx", "a", "copies 2"),
        ("gap", "68", "missing 2 native 104"),
    ]
    with pytest.raises(ValueError, match="integrity check failed"):
        integrity.require_clean(report)
    integrity.require_clean(integrity.integrity_report(chain(spark, 9), txs.limit(1), 36))


def test_scans(spark):
    blocks = chain(spark, 300)
    assert [r.block_num for r in scans.block_range(blocks, 150, 153, ["evm_hash"], 100).collect()] == [150, 151, 152, 153]
    assert scans.block_at(blocks, 150, 100).first().evm_hash == "h150"
    assert scans.block_at(blocks.unionAll(blocks), 150, 100).count() == 0
    assert scans.block_at(blocks, 1, 100).count() == 0
    assert scans.first_block(blocks).first().block_num == 100
    assert scans.last_block(blocks).first().block_num == 399
    assert [r.segment for r in scans.segments_in(blocks, 250, 399, 100).collect()] == [2, 3]
    assert scans.bounded(blocks, 390, -1).count() == 10
    assert scans.bounded(blocks, 390, 391).count() == 2
    assert scans.batch_range(blocks).first()[:] == (100, 399)


def test_range_scan_prunes_partitions_and_pushes_filters(spark, folder):
    chain(spark, 300).write.partitionBy("segment").parquet(folder + "/b")
    stored = spark.read.parquet(folder + "/b")
    plan = scans.block_range(stored, 150, 160, ["evm_hash"], 100)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(block_num,150)" in scan and "LessThanOrEqual(block_num,160)" in scan
    assert "segment" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "evm_prev_hash" not in scan.split("ReadSchema:")[1]


def test_comparison(spark):
    left = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3), (5, "e", 5), (5, "f", 5)], "k int, x string, y int")
    right = spark.createDataFrame([(1, "a", 1), (2, "b", 9), (4, "d", 4), (5, "e", 6), (3, None, None)], "k int, x string, y int")
    got = sorted(map(tuple, compare.compare_tables(left, right, "k").collect()))
    assert got == [
        ("copies", 5, "", 2, 1),
        ("differs", 2, "y", 1, 1),
        ("differs", 3, "x,y", 1, 1),
        ("only_right", 4, "", 0, 1),
    ]
    compare.require_equal(left, left.repartition(3), "k")
    with pytest.raises(ValueError, match="tables differ"):
        compare.require_equal(left, right, "k")


def test_comparison_of_many_copies_pairs_nothing(spark):
    left = spark.range(5000).select(F.lit(1).alias("k"), F.lit("same").alias("x"))
    right = left.limit(4000)
    got = compare.compare_tables(left, right, "k").collect()
    assert [tuple(r) for r in got] == [("copies", 1, "", 5000, 4000)]
