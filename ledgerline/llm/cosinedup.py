"""Near-duplicate embeddings: sign hashes of random hyperplanes propose pairs, exact cosines decide, components group.

``Plan`` draws ``tables`` times ``bits`` hyperplanes. A vector's code in a table is on which sides of that table's planes
it lies; vectors that share a code in any table form a bucket and are compared, in double precision, on the original
numbers. A pair at the threshold lies on the same side of a plane with probability ``1 - acos(least) / pi``; the number of
bits follows the number of vectors (some ``BUCKET`` a bucket if they were spread evenly), the number of tables follows
from both, so that such a pair is missed with probability ``miss`` at most. Nearer pairs are missed far more rarely.

Every pair is counted once: in the first table whose code both share. Buckets are cut into blocks of ``BLOCK``
vectors and every pair of blocks is a unit of work of its own, so no bucket is too large and none is capped. Blocks emit no
pairs, only one row a vector: its number of new links, and one edge to the least member of its group in the block.

Heavy buckets (more than a block) are thinned out exactly first: up to eight of their vectors, spread by hash, are tried as centres,
and what lies within half the angle of a centre forms a cluster. Any two of a cluster are linked by the
triangle inequality, so they are counted by the cluster's size and not compared. A block that holds one cluster only meets
the other blocks, not those of its cluster: a third of all rows that are near copies cost their number, not its square.
Copies too loose for such a cluster are compared block by block: their count of links asks for it.

Equal vectors form a class; classes are compared, and counts weigh each by its rows. Vectors that are null, empty, zero, or
hold null or non-finite components, and rows with a null id, link with nothing: no links, their own component, kept. Vectors
of different lengths aren't compared. Numbers of any finite size are fine, they are scaled first. Rows that repeat an
id keep their own vector's links and component. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import staged
from ledgerline.llm.components import components

#: Vectors of a bucket, if they were spread evenly.
BUCKET = 512
LEAST_BITS = 4
#: Vectors of a block.
BLOCK = 2048
#: Rows of a block that meet all others at a time.
STRIP = 256
CENTRES = 8
SEED = 13
#: A cosine this near the threshold is worked out again from the vectors as they are.
DOUBT = 1e-12
SLACK = 1e-9
#: Of no cluster.
NONE = -1


class Plan(NamedTuple):
    """Threshold and hash tables."""

    least: float
    bits: int
    tables: int

    @classmethod
    def of(cls, n: int, least: float, miss: float) -> Plan:
        bits = max(LEAST_BITS, math.ceil(math.log2(max(n, 1) / BUCKET)))
        same = (1 - math.acos(least) / math.pi) ** bits
        return cls(least, bits, math.ceil(math.log(miss) / math.log(1 - same)))

    def planes(self, dimensions: int) -> np.ndarray:
        return np.random.default_rng([SEED, dimensions]).normal(size=(dimensions, self.tables * self.bits))

    @property
    def centre(self) -> float:
        """Cosine of half the threshold's angle."""
        return math.cos(math.acos(self.least) / 2)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two that bring their largest components near 1: exact, and no square overflows or vanishes."""
    vectors = vectors.astype(np.float64)
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1, keepdims=True))[1])


def units(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.sqrt((vectors**2).sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _usable(vector: Column) -> Column:
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def _coded(classes: DataFrame, plan: Plan) -> DataFrame:
    """``classes(key, id, weight, size, vector)`` with ``codes``, one a table."""
    shift = 1 << np.arange(plan.bits, dtype=np.int32)

    def run(batches):
        planes = {}
        for batch in batches:
            sizes = np.asarray(batch.column("size"))
            codes = np.zeros((len(batch), plan.tables), np.int32)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                if size not in planes:
                    planes[size] = plan.planes(size)
                sides = units(_matrix(batch.column("vector").take(pa.array(at)))) @ planes[size] > 0
                codes[at] = sides.reshape(len(at), plan.tables, plan.bits) @ shift
            offsets = pa.array(np.arange(0, codes.size + 1, plan.tables, dtype=np.int32))
            yield batch.append_column("codes", pa.ListArray.from_arrays(offsets, pa.array(codes.ravel())))

    schema = T.StructType([*classes.schema.fields, T.StructField("codes", T.ArrayType(T.IntegerType()))])
    return classes.mapInArrow(run, schema)


class Links:
    """Links found in a block: a count for each row, and groups as the row that stands for each."""

    def __init__(self, rows: int):
        self.count = np.zeros(rows, np.int64)
        self.root = np.arange(rows)

    def tie(self, a: np.ndarray, b: np.ndarray) -> None:
        x, y = self.root[a], self.root[b]
        while True:
            apart = x != y
            x, y = x[apart], y[apart]
            if not len(x):
                return
            high, low = np.maximum(x, y), np.minimum(x, y)
            np.minimum.at(self.root, high, low)
            while (self.root != (up := self.root[self.root])).any():
                self.root = up
            x, y = self.root[high], self.root[low]


def _compare(part: dict[str, np.ndarray], plan: Plan, table: int) -> Links:
    """Links of one unit of work: rows of the first block against the second, or of one against itself.

    Rows come by ascending id. A pair that shares the code of an earlier table was counted there.
    """
    vectors, codes, cluster, second, weight = (part[c] for c in ("unit", "codes", "cluster", "second", "weight"))
    n = len(vectors)
    links = Links(n)
    if n < 2:
        return links
    alone = not second.any()
    left = np.arange(n) if alone else np.flatnonzero(~second)
    right = left if alone else np.flatnonzero(second)
    other = vectors[right].T
    for at in range(0, len(left), STRIP):
        rows = left[at : at + STRIP]
        cosine = vectors[rows] @ other
        a, b = np.nonzero(cosine >= plan.least - DOUBT)
        cosine, a, b = cosine[a, b], rows[a], right[b]
        keep = a < b if alone else np.ones(len(a), bool)
        keep &= (cluster[a] < 0) | (cluster[a] != cluster[b])
        a, b, cosine = a[keep], b[keep], cosine[keep]
        doubt = np.flatnonzero(np.abs(cosine - plan.least) <= DOUBT)
        if len(doubt):
            x, y = part["scaled"][a[doubt]], part["scaled"][b[doubt]]
            cosine[doubt] = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
        keep = cosine >= plan.least
        keep[keep] = ~(codes[a[keep], :table] == codes[b[keep], :table]).any(1)
        a, b = a[keep], b[keep]
        np.add.at(links.count, a, weight[b])
        np.add.at(links.count, b, weight[a])
        links.tie(a, b)
    return links


WORK = ["size", "table", "code", "i", "j"]


def _found(work: DataFrame, plan: Plan) -> DataFrame:
    """``(key, id, links, least)`` of the rows with links in each unit of sorted ``work``."""

    def unit(batch: pa.RecordBatch):
        vectors = _matrix(batch.column("vector"))
        small = scaled(vectors)
        part = {c: np.asarray(batch.column(c)) for c in ("cluster", "second", "weight", "id", "key")}
        part |= {"scaled": small, "unit": small / np.sqrt((small**2).sum(1, keepdims=True)), "codes": _matrix(batch.column("codes"))}
        order = np.argsort(part["id"], kind="stable")
        part = {name: values[order] for name, values in part.items()}
        links = _compare(part, plan, batch.column("table")[0].as_py())
        hit = np.flatnonzero(links.count)
        ids = part["id"]
        return [part["key"][hit], ids[hit], links.count[hit], ids[links.root[hit]]]

    def flush(parts):
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        return unit(whole)

    def run(batches):
        pending, key = [], None
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in WORK])
            cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(0)) + 1
            out = []
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
                now = tuple(keys[:, begin].tolist())
                if pending and now != key:
                    out.append(flush(pending))
                    pending = []
                pending.append(batch.slice(begin, end - begin))
                key = now
            if out:
                yield _rows(out)
        if pending:
            yield _rows([flush(pending)])

    return work.mapInArrow(run, "key long, id long, links long, least long")


def _rows(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
    columns = [np.concatenate(column).astype(np.int64) for column in zip(*parts, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "id", "links", "least"])


BUCKET_KEY = ["size", "table", "code"]


def _clusters(heavy: DataFrame, plan: Plan) -> DataFrame:
    """``(key, id, cluster)`` of the classes of heavy buckets that lie within half the angle of a centre."""
    tried = heavy.groupBy(*BUCKET_KEY, F.pmod("key", F.lit(CENTRES)).alias("slot")).agg(
        F.min_by(F.struct("key", "vector"), F.xxhash64("key")).alias("centre")
    )
    met = heavy.select(*BUCKET_KEY, "key", "id", "vector").join(tried, BUCKET_KEY)
    met = met.select("size", "key", "id", "vector", F.col("centre.key").alias("of"), F.col("centre.vector").alias("to"))

    def run(batches):
        for batch in batches:
            sizes = np.asarray(batch.column("size"))
            for size in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                cosine = (units(_matrix(part.column("vector"))) * units(_matrix(part.column("to")))).sum(1)
                yield part.select(["key", "id", "of"]).take(pa.array(np.flatnonzero(cosine >= plan.centre + SLACK)))

    near = met.mapInArrow(run, "key long, id long, of long")
    return near.groupBy("key", "id").agg(F.min_by("of", F.xxhash64("of")).alias("cluster"))


def _cut_up(heavy: DataFrame, block: int) -> DataFrame:
    """Units of work of heavy buckets: any two blocks that don't lie in one cluster.

    A cluster that fills a block has blocks of its own in a bucket; all other rows share theirs.
    """
    own = heavy.where("cluster >= 0").groupBy(*BUCKET_KEY, "cluster").agg(F.count("*").alias("held")).where(F.col("held") >= block)
    rows = heavy.join(own, [*BUCKET_KEY, "cluster"], "left")
    rows = rows.withColumn("part", F.when(F.col("held").isNotNull(), F.col("cluster")).otherwise(F.lit(NONE))).drop("held")
    shape = rows.groupBy(*BUCKET_KEY, "part").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    before = Window.partitionBy(*BUCKET_KEY).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shape = shape.withColumns(
        {
            "first": F.coalesce(F.sum("blocks").over(before), F.lit(0)).cast("int"),
            "total": F.sum("blocks").over(Window.partitionBy(*BUCKET_KEY)).cast("int"),
        }
    )
    rows = rows.join(shape, [*BUCKET_KEY, "part"])
    rows = rows.withColumn("at", F.col("first") + F.pmod(F.xxhash64("key", "id"), F.col("blocks")).cast("int"))
    inside = lambda j: (F.col("part") >= 0) & (j >= F.col("first")) & (j < F.col("first") + F.col("blocks"))
    rows = rows.withColumn("to", F.explode(F.filter(F.sequence(F.lit(0), F.col("total") - 1), lambda j: ~inside(j))))
    ends = {"i": F.least("at", "to"), "j": F.greatest("at", "to"), "second": F.col("at") > F.col("to")}
    return rows.withColumns(ends)


def near_duplicates(
    rows: DataFrame, id: str = "vec_id", vector: str = "embedding", least: float = 0.9, miss: float = 1e-3, block: int = BLOCK
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every row; ``kept`` marks the least id of a component."""
    element = rows.schema[vector].dataType.elementType
    kind = "array<float>" if isinstance(element, T.FloatType) else "array<double>"
    rows = rows.select(F.col(id).cast("long").alias("id"), F.col(vector).cast(kind).alias("vector"))
    able = rows.where(F.col("id").isNotNull() & _usable(F.col("vector")))
    able = able.withColumns({"key": F.xxhash64("vector").bitwiseAND(F.lit(2**63 - 1)), "mark": F.hash("vector")})
    classes = able.groupBy("key", "mark", "vector").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    classes = staged(classes.withColumn("size", F.size("vector")), "classes")
    plan = Plan.of(classes.count(), least, miss)

    coded = staged(_coded(classes.select("key", "id", "weight", "size", "vector"), plan), "coded")
    spread = lambda coded: coded.select("*", F.posexplode("codes").alias("table", "code"))
    heavy = spread(coded.select("size", "codes")).groupBy(*BUCKET_KEY).count().where(F.col("count") > block).drop("count")
    heavy = staged(heavy, "heavy")
    whole = {"i": F.lit(0), "j": F.lit(0), "second": F.lit(False)}
    if heavy.isEmpty():
        clusters = None
        work = spread(coded.withColumn("cluster", F.lit(NONE))).withColumns(whole)
    else:
        clusters = staged(_clusters(spread(coded).join(heavy, BUCKET_KEY), plan), "clusters")
        known = coded.join(clusters, ["key", "id"], "left").withColumn("cluster", F.coalesce("cluster", F.lit(NONE)))
        known = spread(staged(known, "known"))
        work = _cut_up(known.join(heavy, BUCKET_KEY), block)
        work = known.join(heavy, BUCKET_KEY, "left_anti").withColumns(whole).unionByName(work.select(*known.columns, *whole))
    work = work.select(*WORK, "second", "key", "id", "weight", "cluster", "vector", "codes")
    found = staged(_found(work.repartition(*WORK).sortWithinPartitions(*WORK), plan), "found")

    counts = found.select("key", "id", "links")
    edges = found.select(F.col("id").alias("a"), F.col("least").alias("b"))
    if clusters is not None:
        members = clusters.join(classes.select("key", "id", "weight"), ["key", "id"])
        whole = members.groupBy("cluster").agg(F.sum("weight").alias("all"), F.min("id").alias("least"))
        members = staged(members.join(whole, "cluster"), "members")
        counts = counts.unionByName(members.select("key", "id", (F.col("all") - F.col("weight")).alias("links")))
        edges = edges.unionByName(members.select(F.col("id").alias("a"), F.col("least").alias("b")))
    groups = components(edges).withColumnRenamed("node", "id")
    counts = counts.groupBy("key", "id").agg(F.sum("links").alias("links"))
    linked = classes.select("key", "mark", "id", "weight").join(counts, ["key", "id"], "left").join(groups, "id", "left")
    linked = linked.select(
        "key",
        "mark",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    usable = F.col("id").isNotNull() & _usable(F.col("vector"))
    marked = rows.select(
        "id",
        F.when(usable, F.xxhash64("vector").bitwiseAND(F.lit(2**63 - 1))).alias("key"),
        F.when(usable, F.hash("vector")).alias("mark"),
    )
    out = marked.join(linked, ["key", "mark"], "left").select(
        F.col("id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return out.withColumn("kept", F.col(id).eqNullSafe(F.col("component_id")))
