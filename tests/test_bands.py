"""Band joins against all pairs."""

import random

import pytest

from ledgerline.operators.bands import band_join


def rows(df):
    return sorted((r.n, r.p, r.lo, r.hi, r.i) for r in df.collect())


@pytest.mark.parametrize("width, part_rows", [(10, 100_000), (10, 7), (1, 50), (1000, 20)])
def test_all_pairs(spark, width, part_rows):
    random.seed(width + part_rows)
    points = [(random.randint(-500, 500), i) for i in range(200)] + [(7, i) for i in range(100)] + [(7, 1), (None, 0)]
    ends = [(lo, lo + random.choice([0, 1, 9, 10, 30, 200, 5000]), i) for i in range(60) for lo in [random.randint(-600, 600)]]
    ends += [(0, 12, 1), (0, 12, 1), (5, 4, 2), (None, 4, 3), (4, None, 4), (-100_000, 100_000, 5)]
    p, i = spark.createDataFrame(points, "n long, p int"), spark.createDataFrame(ends, "lo long, hi long, i int")
    want = sorted((n, a, lo, hi, b) for n, a in points for lo, hi, b in ends if None not in (n, lo, hi) and lo <= n <= hi)
    assert rows(band_join(p, i, "n", "lo", "hi", width, part_rows)) == want


def test_nothing(spark):
    p, i = spark.createDataFrame([(1, 1)], "n long, p int"), spark.createDataFrame([(1, 1, 1)], "lo long, hi long, i int")
    assert band_join(p.limit(0), i, "n", "lo", "hi", 10).count() == 0
    assert band_join(p, i.limit(0), "n", "lo", "hi", 10).count() == 0
    assert rows(band_join(p, i, "n", "lo", "hi", 10)) == [(1, 1, 1, 1, 1)]
