"""Reports from summaries against the report from the tables; comparison by digests against the plain one."""

import random

from pyspark.sql import functions as F

from ledgerline.operators import compare, summaries
from ledgerline.operators.integrity import integrity_report
from ledgerline.plans import jobs
from ledgerline.sources import tables

DELTA, PER_SEGMENT = 2, 10


def stored(spark, blocks, txs):
    blocks = spark.createDataFrame(blocks, "block_num bigint, evm_block_num bigint, segment bigint")
    txs = spark.createDataFrame(txs, "block bigint, hash string, segment bigint")
    return blocks, txs


def found(report):
    return sorted(map(tuple, report.collect()), key=repr)


def odd(seed):
    """Gaps, copies inside and across segments, wrong numbers, a missing segment, repeated and null hashes."""
    pick = random.Random(seed)
    numbers = [n for n in range(100) if n not in (3, 4, 17, 40, 41, 59) and not 70 <= n < 80]
    blocks = [(n + DELTA, n, n // PER_SEGMENT) for n in numbers]
    blocks += [(n + DELTA, n, n // PER_SEGMENT) for n in pick.choices(numbers, k=5)]
    blocks += [(n + DELTA, n, n // PER_SEGMENT + 1) for n in (25, 26, 27, 39)]  # in another segment as well
    blocks += [(50, 47, 4), (12, None, 1), (13, None, 2), (500, 498, 49)]
    txs = [(n, f"h{n}", n // PER_SEGMENT) for n in numbers] + [(5, "h95", 0), (6, "h6", 0), (7, None, 0), (99, None, 9)]
    return blocks, txs


def test_summaries_of_any_split_give_the_report(spark):
    blocks, txs = stored(spark, *odd(1))
    want = found(integrity_report(blocks, txs, DELTA))
    assert len({row[0] for row in want}) == 5
    parts = [summaries.summarise(*[df.where(f"segment % 3 = {k}") for df in (blocks, txs)], DELTA) for k in range(3)]
    merged = {name: parts[2][name].unionByName(parts[0][name]).unionByName(parts[1][name]) for name in parts[0]}
    doubtful = summaries.suspects(merged[summaries.MARKS]).select("mark").distinct()
    held = txs.withColumn("mark", F.xxhash64("hash")).join(doubtful, "mark", "left_semi")
    assert found(summaries.report(merged, held, DELTA)) == want
    small = summaries.coverage(merged[summaries.RUNS], width=3)
    assert found(small) == found(summaries.coverage(merged[summaries.RUNS]))


def test_only_changed_segments_are_read(spark, folder):
    blocks, txs = stored(spark, *odd(2))
    early = "segment < 5"
    for name, df, order in (("blocks", blocks, ("segment", "block_num")), ("transactions", txs, ("segment", "block"))):
        tables.write_table(df.where(early), f"{folder}/{name}", order)
    report, read = jobs.check_changed(spark, folder, DELTA)
    assert found(report) == found(integrity_report(blocks.where(early), txs.where(early), DELTA))
    assert read == [0, 1, 2, 3, 4]
    report, read = jobs.check_changed(spark, folder, DELTA)
    assert set(read) <= {0}  # where a hash occurs twice, and nothing else
    for name, df, order in (("blocks", blocks, ("segment", "block_num")), ("transactions", txs, ("segment", "block"))):
        tables.write_table(df.where(f"not {early}"), f"{folder}/{name}", order)
    report, read = jobs.check_changed(spark, folder, DELTA)
    assert found(report) == found(integrity_report(blocks, txs, DELTA))
    assert set(read) == {0, 5, 6, 8, 9, 49}
    tables.drop_segments(spark, f"{folder}/blocks", [49])
    report, read = jobs.check_changed(spark, folder, DELTA)
    kept = blocks.where("segment <> 49")
    assert found(report) == found(integrity_report(kept, txs, DELTA)) and 49 not in read


def test_nothing_stored(spark, folder):
    report, read = jobs.check_changed(spark, folder, DELTA)
    assert found(report) == [] and read == []


def test_compare_by_digests(spark):
    pick = random.Random(4)
    left = [(n, f"v{n}", n % 7) for n in range(300)] + [(None, "x", 1), (5, "v5", 5), (250, None, None)]
    right = [r for r in left if r[0] not in (17, 250)] + [(600, "new", 0)]
    right = [(n, "changed" if n in (40, 41) else v, s) for n, v, s in right] + [(300, "v300", 1)] * 2
    pick.shuffle(right)
    form = "n bigint, v string, s bigint"
    left, right = spark.createDataFrame(left, form), spark.createDataFrame(right, form)
    part = F.call_function("div", F.col("n"), F.lit(50).cast("bigint"))
    want = found(compare.compare_tables(left, right, "n"))
    assert len({row[0] for row in want}) >= 3
    for buckets in (1, 4, 1024):
        assert found(compare.compare_by_digests(left, right, "n", part, buckets)) == want
    assert found(compare.compare_by_digests(left, left, "n", part)) == []
    apart = compare.differing_parts(left.withColumn("p", part), right.withColumn("p", part), ["p"], left.columns)
    assert sorted(r.p for r in apart.collect()) == [0, 5, 6, 12]


def test_summaries_are_one_folder_a_batch_whatever_the_segments(spark, folder):
    """Before there was a folder a segment and table, with a file a task in each."""
    blocks, txs = stored(spark, *odd(3))
    for part in range(4):
        for name, df, order in (("blocks", blocks, ("segment", "block_num")), ("transactions", txs, ("segment", "block"))):
            tables.write_table(df.where(f"segment % 4 = {part}"), f"{folder}/{name}", order)
        report, _ = jobs.check_changed(spark, folder, DELTA)
    assert found(report) == found(integrity_report(blocks, txs, DELTA))
    place = f"{folder}/{jobs.SUMMARIES}"
    for name in (*jobs.FORMS, jobs.NOTED):
        assert tables.numbered_folders(spark, f"{place}/{name}", "batch=") == [0, 1, 2, 3]
        assert tables.stored_segments(spark, f"{place}/{name}") == []


def test_many_batches_of_summaries_become_one(spark, folder, monkeypatch):
    monkeypatch.setattr(jobs, "SUMMARY_BATCHES", 2)
    blocks, txs = stored(spark, *odd(5))
    for part in range(5):
        now = f"segment % 5 = {part}"
        tables.write_table(blocks.where(now), f"{folder}/blocks", ("segment", "block_num"))
        tables.write_table(txs.where(now), f"{folder}/transactions", ("segment", "block"))
        _, read = jobs.check_changed(spark, folder, DELTA)
        assert {s for s in read if s % 5 != part} <= {0, 9}  # where a hash occurs twice
    tables.drop_segments(spark, f"{folder}/blocks", [1])
    tables.drop_segments(spark, f"{folder}/transactions", [1])
    report, _ = jobs.check_changed(spark, folder, DELTA)
    assert found(report) == found(integrity_report(blocks.where("segment <> 1"), txs.where("segment <> 1"), DELTA))
    assert len(tables.numbered_folders(spark, f"{folder}/{jobs.SUMMARIES}/{jobs.NOTED}", "batch=")) <= 2
