"""Ranges handed over in order and in bounded batches."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import integrity, scans, scroll


def table(spark, numbers):
    df = spark.createDataFrame([(n, i) for i, n in enumerate(numbers)], "block_num bigint, at bigint").repartition(5)
    return scans.with_segment(df, per_segment=50)


@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_all_rows_in_order_whatever_the_batch(spark, batch):
    random.seed(batch)
    numbers = random.sample(range(60), 30) + [3] * 5 + [41] * 20 + [200, 900]
    got = list(scroll.scroll(table(spark, numbers), batch=batch, order=("block_num", "at"), per_segment=50))
    assert all(0 < len(rows) <= batch for rows in got)
    assert [tuple(r)[:2] for rows in got for r in rows] == sorted((n, i) for i, n in enumerate(numbers))


def test_bounds_fields_and_nothing(spark):
    blocks = table(spark, [None, *range(100)])
    got = list(scroll.scroll(blocks, 10, 45, 20, fields=["at"], per_segment=50, prefetch=3))
    assert [r.block_num for rows in got for r in rows] == list(range(10, 46))
    assert got[0][0].asDict() == {"block_num": 10, "at": 11}
    assert list(scroll.scroll(blocks, 500, 600, per_segment=50)) == []


def test_spans_are_as_full_as_their_order_allows(spark):
    found = list(scroll.spans(table(spark, [*range(40), *range(400, 405), 1000]), "block_num", 10))
    assert found == [(0, 9, 10), (10, 19, 10), (20, 29, 10), (30, 39, 10), (400, 1000, 6)]


def test_a_caller_that_stops_early_fetches_little(spark):
    rows = scroll.scroll(table(spark, range(1000)), batch=10, per_segment=50)
    assert [r.block_num for r in next(rows)] == list(range(10))
    rows.close()


def test_invalid_rows_raise_at_their_turn(spark):
    def rule(df):
        return df.withColumn("violations", F.when(F.col("at") == 25, F.array(F.lit("at"))).otherwise(F.array().cast("array<string>")))

    rows = scroll.scroll(table(spark, range(40)), batch=10, fields=[], validate=rule, per_segment=50)
    assert [next(rows)[0].asDict() for _ in range(2)] == [{"block_num": 0}, {"block_num": 10}]
    with pytest.raises(scroll.InvalidRow, match="block_num 25: at"):
        next(rows)


def test_duplicates_by_fingerprint(spark):
    random.seed(2)
    rows = [(random.choice([None, *range(40)]), random.choice("ab")) for _ in range(60)] + [(7, "a")] * 50
    df = spark.createDataFrame(rows, "k bigint, s string")
    for key in ("k", ["k", "s"]):
        got = integrity.duplicates_by_fingerprint(df, key).collect()
        assert sorted(map(str, got)) == sorted(map(str, integrity.duplicates(df, key).collect())) and got
    assert integrity.duplicates_by_fingerprint(df.where("false"), "k").count() == 0
