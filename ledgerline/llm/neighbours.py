"""Approximate nearest neighbours by inner product: few stable projections, kd-tree, chi-square stopping test.

Vectors get one more coordinate that gives all of them the same length, so that the largest inner
product is the least Euclidean distance. ``PROJECTIONS`` Gaussian projections of a distance d are
d times the root of a chi-square variable. A query walks the leaves of the kd-tree of projected
points from the nearest on and measures what they hold, on the original vectors. It stops
once a point as near as its k-th best would have shown up by then with probability ``CERTAINTY``.

The top of the tree is fitted to a sample of at most ``SAMPLE`` vectors (those of least hash) and cuts
all vectors into cells of some ``CELL`` rows. A query first searches its own cell, which bounds the
distance of its k-th best; then every other cell that the same test doesn't rule out; the best
of all are merged. Inside a cell leaves hold ``LEAF`` rows. Every vector is indexed.

Equal vectors are indexed once, with the k + 1 least ids that hold them, and equal queries are searched once.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part.
Rows that repeat id and vector count once. Null ids take no part. Fewer than k candidates give all of them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import staged

PROJECTIONS = 8
CERTAINTY = 0.95
SAMPLE = 20_000
CELL = 20_000
LEAF = 64
#: Queries that one task searches in a cell; a cell that more ask is searched by several tasks.
ASKED = 20_000
SEED = 77


def chi_square(x: np.ndarray, m: int = PROJECTIONS) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.asarray(x, np.float64) / 2
    term = total = np.ones_like(half)
    for i in range(1, m // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-np.minimum(half, 700)) * total


def chi_square_point(p: float, m: int = PROJECTIONS) -> float:
    """Where the distribution function reaches ``p``."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(np.array(middle), m) < p else (low, middle)
    return high


class Space:
    """Common length of all vectors, their projections and the top of the tree.

    Vectors are measured in units of ``scale``, their largest component, and queries in units of their own, so
    that no square leaves the range of doubles. ``length`` counts in the former.
    """

    def __init__(self, dimensions: int, length: float, scale: float = 1.0):
        self.dimensions, self.length, self.scale = dimensions, length, scale
        self.directions = np.random.default_rng(SEED).normal(size=(dimensions + 1, PROJECTIONS))
        self.cuts: list[tuple[int, float]] = []

    def point(self, vectors: np.ndarray) -> np.ndarray:
        """Projections of indexed vectors."""
        vectors = vectors / self.scale
        norms = (vectors**2).sum(1)
        last = np.sqrt(np.maximum(self.length**2 - norms, 0))
        return vectors @ self.directions[:-1] + last[:, None] * self.directions[-1]

    def query(self, vectors: np.ndarray) -> np.ndarray:
        """Projections of queries, brought to the common length."""
        own = vectors / np.abs(vectors).max(1, keepdims=True)
        return (own * (self.length / np.sqrt((own**2).sum(1)))[:, None]) @ self.directions[:-1]

    def reach(self, scores: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Squared distance in the lengthened space at which inner products with these queries fall to ``scores``;
        endless where a score isn't finite."""
        largest = np.abs(queries).max(1)
        norms = np.sqrt(((queries / largest[:, None]) ** 2).sum(1))
        finite = np.isfinite(scores)
        along = np.where(finite, scores, 0) / self.scale / largest / norms
        return np.where(finite, np.maximum(2 * self.length**2 - 2 * self.length * along, 0), np.inf)

    def fit(self, sample: np.ndarray, cells: int) -> None:
        """Cut the sample in halves, along the widest direction each time, until there are ``cells`` parts."""
        self.depth = max(0, math.ceil(math.log2(max(1, cells))))
        self.axis = np.zeros(2**self.depth, np.int64)
        self.value = np.zeros(2**self.depth)
        parts = {1: self.point(sample)}
        for _ in range(self.depth):
            below = {}
            for node, part in parts.items():
                if len(part):
                    self.axis[node] = int(np.ptp(part, axis=0).argmax())
                    self.value[node] = np.median(part[:, self.axis[node]])
                right = part[:, self.axis[node]] > self.value[node]
                below[2 * node], below[2 * node + 1] = part[~right], part[right]
            parts = below

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] > self.value[node])
        return node - 2**self.depth

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of every cell."""
        low = np.full((1, PROJECTIONS), -np.inf)
        high = np.full((1, PROJECTIONS), np.inf)
        for level in range(self.depth):
            nodes = np.arange(2**level, 2 ** (level + 1))
            low, high = np.repeat(low, 2, 0), np.repeat(high, 2, 0)
            left, right = np.arange(0, 2 * len(nodes), 2), np.arange(1, 2 * len(nodes), 2)
            high[left, self.axis[nodes]] = np.minimum(high[left, self.axis[nodes]], self.value[nodes])
            low[right, self.axis[nodes]] = np.maximum(low[right, self.axis[nodes]], self.value[nodes])
        return low, high


def gap2(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        x = points[:, axis, None]
        out += np.maximum(np.maximum(low[:, axis] - x, x - high[:, axis]), 0) ** 2
    return out


def leaves_of(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Rows of each leaf of a kd-tree."""
    out, stack = [], [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        axis = int(np.ptp(points[rows], axis=0).argmax())
        order = np.argpartition(points[rows, axis], len(rows) // 2)
        stack += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


def inner(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products, summed in the order of the components, so that equal vectors get equal scores."""
    out = np.zeros((len(queries), len(vectors)))
    with np.errstate(over="ignore", invalid="ignore"):
        for axis in range(vectors.shape[1]):
            out += queries[:, axis, None] * vectors[:, axis]
    return out


def search(space: Space, vectors: np.ndarray, queries: np.ndarray, k: int, bound: np.ndarray, point: float):
    """Rows and scores of the ``k`` best of one cell for each query, -1 where there are fewer.

    ``bound`` is the score of each query's k-th best elsewhere, or -inf.
    """
    points, projected = space.point(vectors), space.query(queries)
    leaves = leaves_of(points)
    low, high = (np.array([f(points[rows], axis=0) for rows in leaves]) for f in (np.min, np.max))
    gaps = gap2(projected, low, high)
    order = np.argsort(gaps, axis=1, kind="stable")
    best = np.full((len(queries), k), -np.inf)
    rows_of = np.full((len(queries), k), -1, np.int64)
    active = np.arange(len(queries))
    begin, width = 0, 1
    while begin < len(leaves) and len(active):
        worst = np.maximum(best[active, -1], bound[active])
        reach = space.reach(worst, queries[active]) * point
        window = order[active, begin : begin + width]
        going = np.take_along_axis(gaps[active], window, 1) <= reach[:, None]
        at, turn = np.nonzero(going)
        leaf_of = window[at, turn]
        by_leaf = np.argsort(leaf_of, kind="stable")
        for part in np.split(by_leaf, np.flatnonzero(np.diff(leaf_of[by_leaf])) + 1) if len(at) else ():
            who, rows = active[at[part]], leaves[leaf_of[part[0]]]
            scores = np.concatenate([best[who], inner(vectors[rows], queries[who])], 1)
            names = np.concatenate([rows_of[who], np.broadcast_to(rows, (len(who), len(rows)))], 1)
            # rows stand for ids in ascending order, so ties go to the smaller row
            top = np.lexsort((names, -scores), axis=1)[:, :k]
            best[who], rows_of[who] = np.take_along_axis(scores, top, 1), np.take_along_axis(names, top, 1)
        active = active[going[:, -1]]  # leaves come by distance: one ruled out ends the walk
        begin, width = begin + width, 2 * width
    return rows_of, best


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64) if len(column) else np.zeros((0, 1))


def _lists(values) -> pd.Series:
    """A column of lists, of that kind even if empty."""
    values = list(values)
    out = np.empty(len(values), object)
    for at, value in enumerate(values):
        out[at] = value
    return pd.Series(out)


FOUND = "query array<double>, bound double, best array<struct<score:double,ids:array<bigint>>>"


def _search_cells(index: DataFrame, asked: DataFrame, space: Space, k: int, point: float) -> DataFrame:
    """``best`` of each row of ``asked(cell, query, bound)`` in its cell of ``index(cell, vector, ids)``."""

    shares = asked.groupBy("cell").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("parts"))
    asked = asked.join(shares, "cell").withColumn("part", F.pmod(F.xxhash64("query"), "parts").cast("int"))
    copies = shares.select(F.col("cell"), F.col("parts").alias("copies"))
    index = index.join(copies, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    asked, index = asked.select("cell", "part", "query", "bound"), index.select("cell", "part", "vector", "ids")

    def run(_, rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asks):
            empty = [[] for _ in range(len(asks))]
            return pd.DataFrame({"query": _lists(asks["query"]), "bound": asks["bound"].astype(float), "best": _lists(empty)})
        rows = rows.iloc[rows["ids"].map(lambda i: i[0]).argsort(kind="stable")]
        vectors, queries = _matrix(rows["vector"]), _matrix(asks["query"])
        ids = rows["ids"].to_list()
        found, scores = search(space, vectors, queries, k + 1, asks["bound"].to_numpy(), point)
        best = [
            [{"score": s, "ids": ids[r]} for r, s in zip(own, of, strict=True) if r >= 0]
            for own, of in zip(found.tolist(), scores.tolist(), strict=True)
        ]
        return pd.DataFrame({"query": _lists(queries), "bound": asks["bound"], "best": _lists(best)})

    return index.groupBy("cell", "part").cogroup(asked.groupBy("cell", "part")).applyInPandas(run, FOUND)


def nearest(
    vectors: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 20, certainty: float = CERTAINTY
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best of ``vectors`` for each row of ``queries``, its own id left out."""
    usable = _usable(vectors, id, vector)
    unit = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.col("largest")) * (x / F.col("largest")))
    norm = F.log(F.col("largest")) + F.log(unit) / 2  # as a logarithm: a sum of squares may leave the range of doubles
    shapes = usable.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"), F.max(norm).alias("norm"), F.max("largest").alias("largest"))
    shape = shapes.orderBy(F.desc("rows"), F.desc("n")).first()
    if shape is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    space = Space(shape.n, math.exp(shape.norm - math.log(shape.largest)), shape.largest)
    length_of = F.size("vector") == shape.n
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    distinct = usable.where(length_of).select("id", "vector").distinct()
    equal = distinct.withColumn("place", place).where(F.col("place") <= k + 1)
    index = equal.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    index = staged(index, "vectors")
    rows = index.count()
    sample = index.select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE).toPandas()
    space.fit(_matrix(sample["vector"]), -(-rows // CELL))

    def cells(batches):
        for batch in batches:
            batch["cell"] = space.cell(space.point(_matrix(batch["vector"]))) if len(batch) else []
            yield batch

    def homes(batches):
        for batch in batches:
            own = space.query(_matrix(batch["query"])) if len(batch) else None
            batch["cell"] = space.cell(own) if len(batch) else []
            yield batch

    low, high = space.boxes()
    point = chi_square_point(certainty)

    def further(batches):
        """Other cells that may hold one of the k best."""
        for batch in batches:
            if not len(batch):
                continue
            q = _matrix(batch["query"])
            own = space.query(q)
            worst = batch["bound"].to_numpy()
            may = gap2(own, low, high) <= (space.reach(worst, q) * point)[:, None]
            may[np.arange(len(q)), space.cell(own)] = False
            at, cell = np.nonzero(may)
            yield pd.DataFrame({"cell": cell, "query": _lists(q[i] for i in at), "bound": worst[at]})

    index = staged(index.mapInPandas(cells, "vector array<double>, ids array<bigint>, cell long"), "cells")
    asked = _usable(queries, id, vector).where(length_of).select(F.col("id").alias("query_id"), F.col("vector").alias("query")).distinct()
    once = asked.select("query").distinct()
    first = staged(once.mapInPandas(homes, "query array<double>, cell long").withColumn("bound", F.lit(float("-inf"))), "asked")
    first = staged(_search_cells(index, first, space, k, point), "first")
    # the k-th best of the own cell, counting ids; the query's own id may be one of them
    seen = F.aggregate("best", F.struct(F.lit(0).alias("n"), F.lit(float("-inf")).alias("s")), _kth(k + 1), lambda a: a["s"])
    bounds = first.select("query", seen.alias("bound"))
    more = staged(bounds.mapInPandas(further, "cell long, query array<double>, bound double"), "asked")
    second = _search_cells(index, more, space, k, point)
    both = first.select("query", "best").unionByName(second.select("query", "best"))
    hits = both.select("query", F.explode("best").alias("b")).select("query", F.col("b.score").alias("score"), F.explode("b.ids").alias("vec_id"))
    in_order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    hits = hits.withColumn("place", F.row_number().over(in_order)).where(F.col("place") <= k + 1)
    lists = hits.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("hits"))
    out = asked.join(lists, "query")
    out = out.select("query_id", F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")).alias("hits"))
    out = out.select("query_id", F.posexplode(F.slice("hits", 1, k)).alias("at", "h"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("h.vec_id").alias("vec_id"), F.col("h.score").alias("score"))


def _kth(k: int):
    """Fold over the best of a cell: the score at which ``k`` ids are reached."""

    def step(a, b):
        n = a["n"] + F.size(b["ids"])
        reached = (a["n"] < k) & (n >= k)
        return F.struct(n.alias("n"), F.when(reached, b["score"]).otherwise(a["s"]).alias("s"))

    return step


def _usable(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """``(id, vector, largest)`` of the rows that take part, in double precision, with their largest component's size."""
    rows = rows.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & sound)
    return rows.withColumn("largest", F.array_max(F.transform("vector", F.abs))).where("largest > 0")
