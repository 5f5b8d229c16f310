import os

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.scans import with_segment
from ledgerline.sources import actions, tables

PER = 10


def blocks(spark, lo, hi, version="v"):
    made = spark.range(lo, hi + 1).select(
        F.col("id").alias("block_num"),
        (F.col("id") - 2).alias("evm_block_num"),
        F.concat(F.lit(version), F.col("id")).alias("evm_hash"),
    )
    return complete(with_segment(made, "block_num", PER), S.BLOCKS)


def txs(spark, lo, hi, each=2):
    made = (
        spark.range(lo, hi + 1)
        .withColumn("trx_index", F.explode(F.sequence(F.lit(0), F.lit(each - 1))))
        .select((F.col("id") - 2).alias("block"), F.col("id").alias("block_num"), "trx_index")
    )
    return complete(with_segment(made, "block_num", PER), S.TRANSACTIONS)


def complete(df, schema):
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def stored(spark, path, column="block_num"):
    return sorted(r[0] for r in spark.read.parquet(path).select(column).collect())


@pytest.fixture
def chain(spark, folder):
    tables.append_blocks(blocks(spark, 5, 34), txs(spark, 5, 34), None, folder, S.BLOCKS, S.TRANSACTIONS)
    return folder


def test_append_is_create_only_and_contiguous(spark, chain):
    assert tables.last_number(spark, chain + "/blocks") == 34
    assert tables.stored_segments(spark, chain + "/blocks") == [0, 1, 2, 3]
    with pytest.raises(tables.NotContiguous, match="Expected: 35 and got 36"):
        tables.append_blocks(blocks(spark, 36, 37), txs(spark, 36, 37), None, chain, S.BLOCKS, S.TRANSACTIONS)
    with pytest.raises(tables.NotContiguous):
        gap = blocks(spark, 35, 39).where("block_num <> 37")
        tables.append_blocks(gap, txs(spark, 35, 39), None, chain, S.BLOCKS, S.TRANSACTIONS)
    with pytest.raises(tables.KeyClash):
        tables.append_create_only(blocks(spark, 34, 36), chain + "/blocks", S.BLOCKS, "block_num")
    with pytest.raises(tables.KeyClash):
        twice = blocks(spark, 35, 35).unionAll(blocks(spark, 35, 35))
        tables.append_create_only(twice, chain + "/blocks", S.BLOCKS, "block_num")
    notice = tables.append_blocks(blocks(spark, 35, 41), txs(spark, 35, 41), None, chain, S.BLOCKS, S.TRANSACTIONS)
    assert notice == (35, 41)
    assert stored(spark, chain + "/blocks") == list(range(5, 42))
    assert stored(spark, chain + "/transactions") == sorted([*range(5, 42)] * 2)


def test_purge_drops_segments_and_cuts_the_edge(spark, chain):
    tables.purge_chain_from(spark, chain, 17, 2, PER)
    assert stored(spark, chain + "/blocks") == list(range(5, 17))
    assert stored(spark, chain + "/transactions") == sorted([*range(5, 17)] * 2)
    assert tables.stored_segments(spark, chain + "/blocks") == [0, 1]
    tables.purge_chain_from(spark, chain, 17, 2, PER)
    tables.trim_from(spark, chain, 10, 2, PER)
    assert stored(spark, chain + "/blocks") == list(range(5, 10))
    assert tables.stored_segments(spark, chain + "/transactions") == [0]
    tables.purge_chain_from(spark, chain, 0, 2, PER)
    assert tables.last_number(spark, chain + "/blocks") is None


def test_delete_touches_every_segment_of_the_range(spark, chain):
    tables.delete_range(spark, chain + "/blocks", 8, 31, per_segment=PER)
    assert stored(spark, chain + "/blocks") == [5, 6, 7, 32, 33, 34]
    tables.delete_range(spark, chain + "/transactions", 8, 31, "block", 2, PER, tables.TRANSACTION_ORDER)
    assert stored(spark, chain + "/transactions") == sorted([5, 6, 7, 32, 33, 34] * 2)


def test_only_the_files_of_the_range_are_rewritten(spark, folder):
    path = folder + "/t"
    for lo in (0, 3, 6):
        tables.write_table(blocks(spark, lo, lo + 2), path, tables.BLOCK_ORDER, files=1)
    before = set(os.listdir(path + "/segment=0"))
    tables.purge_from(spark, path, 7, per_segment=PER)
    after = set(os.listdir(path + "/segment=0"))
    assert len([f for f in before & after if f.endswith(".parquet")]) == 2
    assert stored(spark, path) == list(range(7))


@pytest.mark.parametrize("step", ["before marker", "before moving", "half moved"])
def test_a_lost_purge_is_finished_by_the_next_job(spark, folder, monkeypatch, step):
    path = folder + "/t"
    tables.write_table(blocks(spark, 0, 9), path, tables.BLOCK_ORDER, files=2)
    monkeypatch.setattr(tables, "_finish_replacing", lambda *a: None)
    tables.purge_from(spark, path, 2, per_segment=PER)
    monkeypatch.undo()
    assert stored(spark, path) == list(range(10))
    job = next(f for f in os.listdir(path) if f.startswith("_replace-"))
    if step == "before marker":
        os.remove(f"{path}/{job}/READY")
        tables._finish_replacing(spark, path)
        assert stored(spark, path) == list(range(10))
    if step == "half moved":
        for line in open(f"{path}/{job}/READY").read().split("\n")[1:]:
            os.remove(line.removeprefix("file://").removeprefix("file:"))
    tables.purge_from(spark, path, 2, per_segment=PER)
    assert stored(spark, path) == [0, 1]
    assert not [f for f in os.listdir(path) if f.startswith("_replace-")]


def test_nothing_staged_is_left_behind(spark, chain):
    tables.purge_chain_from(spark, chain, 17, 2, PER)
    shared = spark.conf.get("spark.checkpoint.dir")
    assert not [name for name in os.listdir(shared) if name.startswith("staged-")]


def test_dump_is_loaded_only_when_counts_differ(spark, folder):
    path = folder + "/t"
    assert tables.load_dump(spark, blocks(spark, 1, 20, "a"), path, 20).count() == 20
    kept = tables.load_dump(spark, blocks(spark, 1, 20, "b"), path, 20)
    assert kept.where("evm_hash like 'a%'").count() == 20
    again = tables.load_dump(spark, blocks(spark, 1, 25, "b"), path, 25)
    assert again.where("evm_hash like 'b%'").count() == 25
    with pytest.raises(ValueError, match="manifest"):
        tables.load_dump(spark, blocks(spark, 1, 3), path, 4)


def test_one_segment_is_written_by_many_tasks(spark, folder):
    tables.write_table(blocks(spark, 0, 9).crossJoin(spark.range(500)).drop("id"), folder + "/t", tables.BLOCK_ORDER, files=4)
    files = spark.read.parquet(folder + "/t").select(F.input_file_name()).distinct().count()
    assert files == 4


def test_actions_are_filtered_at_the_source(spark, folder):
    rows = [("eosio.evm", "raw", 5), ("eosio.evm", "other", 5), ("x", "raw", 5), ("eosio.token", "transfer", 9)]
    made = spark.createDataFrame(rows, "account string, name string, block_num bigint")
    complete(made, S.ACTIONS).write.parquet(folder + "/a")
    read = actions.read_actions(spark, folder + "/a", stop=8)
    assert [(r.account, r.name) for r in read.collect()] == [("eosio.evm", "raw")]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    read = actions.read_actions(spark, folder + "/a", stop=8)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(block_num,8)" in plan and "EqualTo(account,eosio.evm)" in plan
    assert actions.irreversible(read, 4).count() == 0


def test_purge_below_a_folder_whose_name_needs_escaping(spark, folder):
    path = f"{folder}/with space 100%/blocks"
    rows = spark.range(1, 21).select(F.col("id").alias("block_num"), F.lit(0).cast("bigint").alias("segment"))
    tables.write_table(rows, path, ("block_num",))
    tables.purge_from(spark, path, 11, order=("block_num",))
    assert spark.read.parquet(path).agg(F.max("block_num")).first()[0] == 10
