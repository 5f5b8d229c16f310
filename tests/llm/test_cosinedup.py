"""Against all cosines of small tables."""

import numpy as np
import pytest

from ledgerline.llm import cosinedup, shape_queries  # noqa: F401
from ledgerline.llm.registry import QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def brute(ids, vectors):
    v = np.array(vectors, float)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    least = np.array(ids)
    while True:
        new = np.minimum(least, np.where(linked, least[None, :], least.max()).min(1))
        if (new == least).all():
            break
        least = new
    return {i: (int(linked[at].sum()), int(least[at]), i == least[at]) for at, i in enumerate(ids)}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/check_s", "/root/testdata/check_h"])
def test_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas().sort_values("vec_id")
    got, want = result(QUERIES["op13_embedding_groups"](spark, folder)), brute(rows["vec_id"].tolist(), np.stack(rows["embedding"]))
    assert got.keys() == want.keys()
    found, all_ = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
    assert found <= all_ and found >= 0.999 * all_
    assert sum(got[i] != want[i] for i in want) <= 0.001 * len(want)


@pytest.mark.parametrize("block", [2048, 100, 40])
def test_large_groups_in_small_blocks(spark, block):
    """A tight group (one cluster), a loose one (no cluster), chains between, noise and exact copies."""
    random = np.random.default_rng(1)
    centre = random.normal(size=16)
    tight = centre + 0.02 * random.normal(size=(400, 16))
    loose = random.normal(size=16) + 0.28 * random.normal(size=(200, 16))
    vectors = np.concatenate([tight, loose, random.normal(size=(400, 16)), tight[:150]])
    ids = random.permutation(len(vectors)).tolist()
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], SCHEMA)
    got, want = result(cosinedup.near_duplicates(rows, block=block, miss=1e-7)), brute(ids, vectors)
    assert got == want


def test_odd_vectors(spark):
    """At the threshold, just below it, far beyond the squares' range, of another length, and unusable ones."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0, 0.0]), (2, [9.0, 3.0, 3.0, 1.0]), (3, [9.0, 3.0, 3.0, 1.001]), (10, [1e200, 0.0, 0.0, 0.0])]
    rows += [(11, [1e-200, 0.0, 0.0, 0.0]), (12, [1.0, 0.0, 0.0]), (13, [-1.0, 0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0])]
    rows += [(4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (15, [0.0, -0.0])]
    rows += [(14, [0.0, 1.0, 0.0]), (14, [0.0, 1.0, 0.0])]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as key", "3 as size", "4 as weight")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in cosinedup.near_duplicates(table, miss=1e-9).collect())
    alone = [(i, 0, i, True) for i in (0, 4, 5, 6, 7, 8, 9, 12, 13, 15)]
    group = [(1, 3, 1, True), (2, 4, 1, False), (3, 1, 1, False), (10, 3, 1, False), (11, 3, 1, False), (14, 1, 14, True), (14, 1, 14, True)]
    assert got == sorted(alone + group)


def test_nothing(spark):
    assert cosinedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
