"""Recall against brute force; scores, ties and odd rows exactly."""

import math

import numpy as np
import pytest

from ledgerline.llm import data_queries, neighbours  # noqa: F401
from ledgerline.llm.registry import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def brute(rows, asked, k):
    """Ids and scores of the best ``k``, by plain sums."""
    out = {}
    for q, v in asked:
        scores = []
        for i, w in rows:
            if i != q:
                total = 0.0
                for x, y in zip(v, w, strict=True):
                    total += x * y
                scores.append((-total, i))
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    assert got.keys() == want.keys() and all(len(got[q]) == len(want[q]) for q in want)
    return sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))


def test_recall_of_the_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got = result(QUERIES["op3_neighbours"](spark, MEDIUM))
    assert recall(got, want) >= 0.95
    exact = {(q, i): s for q, hits in want.items() for i, s in hits}
    assert all(s == exact[q, i] for q, hits in got.items() for i, s in hits if (q, i) in exact)


@pytest.mark.parametrize("cell", [200, 10_000])
def test_several_cells_and_lengths(spark, monkeypatch, cell):
    monkeypatch.setattr(neighbours, "CELL", cell)
    monkeypatch.setattr(neighbours, "ASKED", 20)
    random = np.random.default_rng(2)
    centres = random.normal(size=(12, 24)) * 2
    vectors = centres[random.integers(0, 12, 1500)] + random.normal(size=(1500, 24)) * 0.4
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = result(neighbours.nearest(df, df.where("vec_id % 20 = 0"), k=10))
    assert recall(got, brute(rows, rows[::20], 10)) >= 0.9


def test_copies_ties_and_rows_that_take_no_part(spark):
    nan, inf = float("nan"), math.inf
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100, [0.0, 1.0]), (101, [0.5, 0.5]), (102, [0.0, -0.0]), (103, None), (104, [nan, 1.0])]
    rows += [(105, [inf, 0.0]), (106, [None, 1.0]), (107, [1.0]), (None, [1.0, 0.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as cell", "2 as id", "3 as query")
    got = result(neighbours.nearest(df, df.where("vec_id in (0, 40, 100, 102, 103, 107)"), k=5))
    assert got == {
        0: [(i, 1.0) for i in (1, 2, 3, 4, 5)],
        40: [(i, 1.0) for i in (0, 1, 2, 3, 4)],
        100: [(101, 0.5)] + [(i, 0.0) for i in (0, 1, 2, 3)],
    }
    few = df.where("vec_id in (100, 101)")
    assert result(neighbours.nearest(few, few)) == {100: [(101, 0.5)], 101: [(100, 0.5)]}
    assert neighbours.nearest(df.limit(0), df).count() == 0 and neighbours.nearest(df, df.limit(0)).count() == 0


def test_stopping_point():
    assert neighbours.chi_square(np.array([neighbours.chi_square_point(0.9)]), 8)[0] == pytest.approx(0.9)
    assert neighbours.chi_square_point(0.95, 2) == pytest.approx(-2 * math.log(0.05))


@pytest.mark.parametrize("size", [1e160, 1e-170, 1e300])
def test_components_whose_squares_leave_the_range(spark, size):
    random = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(random.normal(size=(60, 8)))] + [(60, [size] * 8), (61, [size / 2] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = result(neighbours.nearest(df, df.where("vec_id % 20 = 0"), k=10))
    assert got == brute(rows, [r for r in rows if r[0] % 20 == 0], 10)
