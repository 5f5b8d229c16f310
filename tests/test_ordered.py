import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import ordered as O


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows."""
    random.seed(1)
    rows, position = [], {}
    for _ in range(900):
        key = 7 if random.random() < 0.34 else random.randrange(40)
        position[key] = position.get(key, -1) + 1
        rows.append((key, position[key], random.randrange(100)))
    random.shuffle(rows)
    return spark.createDataFrame(rows, "k bigint, p bigint, v bigint").repartition(5)


@pytest.mark.parametrize("width", [10, 10_000])
def test_running_totals_are_the_same_in_parts(skewed, width):
    spread = O.bucket_of(F.col("p"), width)
    out = O.running_totals(skewed, "k", ["p"], spread, {"total": F.col("v"), "rank": F.lit(1).cast("bigint")})
    plain = sorted(map(tuple, out.select("k", "p", "v", "total", "rank").collect()))
    sums = {}
    for k, p, v, total, rank in plain:
        sums[k] = sums.get(k, 0) + v
        assert total == sums[k] and rank == p + 1


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("width", [3, 10, 1000])
def test_neighbours_match_a_plain_walk(spark, after, width):
    random.seed(width)
    positions = sorted(random.sample(range(-500, 3000), 300))
    rows = [(p, p * 7) for p in positions]
    df = spark.createDataFrame(rows, "p bigint, v bigint").repartition(4)
    got = O.neighbours(df, "p", {"w": "v"}, after=after, width=width).select("p", "w").collect()
    step = 1 if after else -1
    expected = {
        p: (positions[i + step] * 7 if 0 <= i + step < len(positions) else None)
        for i, p in enumerate(positions)
    }
    assert dict(map(tuple, got)) == expected


@pytest.mark.parametrize("width", [2, 7, 1000])
def test_minimum_after_matches_a_plain_walk(spark, width):
    random.seed(width)
    values = [random.randrange(50) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(values)), "p bigint, v bigint").repartition(4)
    got = dict(map(tuple, O.minimum_after(df, "p", "v", "m", width=width).select("p", "m").collect()))
    assert got == {i: min(values[i + 1 :], default=None) for i in range(len(values))}


def test_explode_range_in_chunks(spark):
    df = spark.createDataFrame([(5, 5), (10, 45), (3, 2)], "a bigint, b bigint")
    got = O.explode_range(df, F.col("a"), F.col("b"), "n", chunk=10).select("n").collect()
    assert sorted(r.n for r in got) == [5, *range(10, 46)]


@pytest.mark.parametrize("cells", [1, 65_536])
def test_large_keys_are_those_of_more_rows_than_the_width(spark, monkeypatch, cells):
    monkeypatch.setattr(O, "_CELLS", cells)
    rows = [(k,) for k in range(-5, 12) for _ in range(abs(k))] + [(None,)] * 50
    df = spark.createDataFrame(rows, "k bigint")
    assert sorted(r.k for r in O.large_keys(df, "k", 8).collect()) == [9, 10, 11]
    assert O.large_keys(df, "k", 11).collect() == []
