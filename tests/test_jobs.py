import pytest
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.compare import require_equal
from ledgerline.plans import jobs
from ledgerline.sources import tables
from test_tables import PER, blocks, chain, stored, txs  # noqa: F401  (chain is a fixture)


@pytest.fixture
def linked(spark, folder):
    made = blocks(spark, 5, 34).withColumns(
        {
            "evm_prev_hash": F.concat(F.lit("v"), F.col("block_num") - 1),
            "gas_used": F.lit(0).cast("decimal(38,0)"),
        }
    )
    moved = txs(spark, 5, 34).withColumns(
        {"hash": F.concat_ws("-", "block", "trx_index"), "gasused": F.lit(7).cast("decimal(38,0)")}
    )
    source = folder + "/source"
    tables.append_blocks(made, moved, None, source, S.BLOCKS, S.TRANSACTIONS)
    return source


def test_start_after_the_last_block(spark, linked):
    assert jobs.check(spark, linked, 2).count() == 0
    point = jobs.start_point(spark, linked, 2, 36, trim=30, per_segment=PER)
    assert (point.block, point.prev_hash, point.source) == (29, "v28", "last block")
    assert stored(spark, linked + "/blocks") == list(range(5, 29))


def test_gap_is_an_error_unless_it_may_be_purged(spark, linked):
    tables.delete_range(spark, linked + "/blocks", 15, 22, per_segment=PER)
    with pytest.raises(Exception, match="Gap found in database at 12"):
        jobs.start_point(spark, linked, 2, 36, per_segment=PER)
    point = jobs.start_point(spark, linked, 2, 36, purge_gaps=True, per_segment=PER)
    assert (point.block, point.prev_hash, point.source) == (14, "v13", "gap")
    assert stored(spark, linked + "/blocks") == list(range(5, 14))


def test_reindex_resumes_and_gives_the_same_blocks(spark, linked, folder):
    target = folder + "/target"
    with pytest.raises(ValueError, match="initial hash validation failed"):
        jobs.reindex(spark, linked, target, 2, 6, 20, "other", PER)
    assert jobs.reindex(spark, linked, target, 2, 6, 20, "v6", PER) == (6, 20)
    assert jobs.reindex(spark, linked, target, 2, 6, 34, per_segment=PER) == (21, 34)
    keep = ["block_num", "evm_block_num", "evm_hash", "evm_prev_hash"]
    old, new = (spark.read.parquet(f + "/blocks") for f in (linked, target))
    require_equal(old.where("block_num >= 6").select(*keep), new.select(*keep), "block_num")
    assert {(r.gas_used, r.tx_count) for r in new.collect()} == {(14, 2)}
    hashes = spark.read.parquet(target + "/transactions").select("block_num", "block_hash").distinct().collect()
    assert {(r.block_num, r.block_hash) for r in hashes} == {(n, f"v{n}") for n in range(6, 35)}
