"""Hex text that is shuffled as bytes comes back as it was."""

from pyspark.sql import functions as F

from ledgerline.functions.hexes import packed, unpacked
from ledgerline.operators.ordered import running_totals
from ledgerline.plans import chain_queries
from ledgerline.sources import tables

ODD = ["00ff", "00FF", "abc", "", None, "0x12", "xyz", " ab", "é", "a" * 64, "0" * 512]


def test_any_text_survives(spark):
    df = spark.createDataFrame([(i, text, text) for i, text in enumerate(ODD)], "i int, hash string, other string")
    back = unpacked(packed(df, ["hash", "other"]), ["hash", "other"])
    assert back.columns == df.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    held = packed(df, ["hash"]).where("_packed_hash is not null and hash is null").count()
    assert held == 4  # even, lower-case digits, or none at all


def test_totals_and_new_rows_with_hashes(spark):
    rows = [(n % 3, n, ODD[n % len(ODD)]) for n in range(40)] + [(None, 1, "ab")]
    df = spark.createDataFrame(rows, "block bigint, n bigint, hash string")
    plain, with_hex = (running_totals(df, "block", ["n"], F.col("n"), {"total": F.col("n")}, hexes) for hexes in ((), ("hash",)))
    assert plain.columns == with_hex.columns
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, with_hex.collect()))
    stored = spark.createDataFrame([(1,), (2,)], "block bigint")
    new = tables.new_rows(df, stored, "block").collect()
    assert sorted(map(repr, new)) == sorted(map(repr, df.where("block = 0 or block is null").collect()))


def test_sent_rows_are_staged_once(spark, small, monkeypatch):
    """The index of all transactions was worked out twice, once for those stored and once for the new ones."""
    stages = []
    plain = tables.staged
    monkeypatch.setattr(tables, "staged", lambda df: stages.append(df.columns) or plain(df))
    made = chain_queries.create_only_append(spark, small)
    assert stages == [["block", "trx_index", "hash", "segment"]] * 2
    want = spark.read.parquet(f"{small}/lineitem.parquet").count()
    assert made.count() == want and made.select("block", "trx_index").distinct().count() == want
