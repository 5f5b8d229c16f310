"""Near-duplicate documents: MinHash bands propose pairs, sequential Bayesian checks prune them,
full shingle sets decide.

A document is the set of its distinct shingles of ``k`` words. Two documents are linked if the
Jaccard similarity of their sets reaches ``percent`` / 100. Documents with equal sets form a
class, and only classes are compared. Classes that share a band form a bucket:

1. in a few rounds one class of each component of a bucket is checked against one class of the bucket's
   commonest component (at first every class is a component), and what links is tied together. Large groups
   come together in a number of pairs that grows with the group, not with its square;
2. buckets that still hold several components are searched whole. A class outside its bucket's commonest
   component is compared with all of that component, in blocks that hold the texts and emit one link at most
   for each class; and, once more in blocks, with the other such classes of the bucket, of which only pairs that
   stay plausible leave a block.

A check compares one byte per hash, ``STEP`` hashes at a time, and drops a pair once the
posterior probability of a link (uniform prior) is below ``miss``. What remains is decided by
the full sets. No bucket is capped.

Bands of 5 hashes, 32 of them, miss a pair at 0.8 with a probability of 3e-6.

Null ids take no part: they come back with a null component, and are kept. Rows that repeat an id
count as one node with the links of each. Null and empty texts have no shingles and no links.
An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (as pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bpe import chunks
from ledgerline.llm.common import arrow_rows, broadcast_if_small, give_back, staged
from ledgerline.llm.components import components

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Hashes compared before a pair is judged again.
STEP = 32
#: Rounds that tie groups together: buckets of a class that count, and which class stands for a component.
ROUNDS = [(4, ("least", "least")), (BANDS, ("least", "least")), (BANDS, ("largest", "largest")), (BANDS, ("least", "largest"))]
#: Classes of one side of a block.
BLOCK = 512
#: Up to so many ids (8 bytes each) are sent to every executor to select texts; beyond, both sides shuffle.
BROADCAST_IDS = 2_000_000
SEED = 20_240_607
CHUNK = 1 << 18
#: Rows of a batch between engine and Python; pairs carry two whole texts.
BATCH = 1_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of the word shingles of texts."""

    def __init__(self, k: int):
        random = np.random.default_rng(SEED)
        self.k = k
        self.values = random.integers(0, 2**64, 256, np.uint64)
        self.values[65:91] = self.values[97:123]  # A-Z as a-z
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.order = random.integers(0, 2**63, k, np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = self.inverses = np.ones(1, np.uint64)
        self.multiply = (random.integers(0, 2**31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.add = random.integers(0, 2**32, HASHES, np.uint32)[:, None]

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.base)]))
            self.inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.inverse)]))

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        raw = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
        self._grow(len(raw) + 1)
        blank = self.space[raw]
        starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.values[raw] * self.powers[: len(raw)], out=sums[1:])
        words = _mix((sums[ends] - sums[starts]) * self.inverses[starts])
        borders = np.cumsum([1] + [len(t) + 1 for t in texts])
        first = np.searchsorted(starts, borders)
        out = []
        padded = np.concatenate([words, np.zeros(self.k, np.uint64)])
        windows = np.zeros(len(words), np.uint64)
        for i in range(self.k):
            windows += padded[i : i + len(words)] * self.order[i]
        windows = _mix(windows)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= self.k:
                out.append(np.unique(windows[a : b - self.k + 1]))
            elif b > a:
                whole = (words[a:b] * self.order[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                out.append(_mix(np.array([whole])))
            else:
                out.append(words[:0])
        return out

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Least value of each hash function over a set."""
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(short), 8192):
            grid = short[None, at : at + 8192] * self.multiply
            grid += self.add
            np.minimum(least, grid.min(1), out=least)
        return least


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def sketches(docs: DataFrame, id: str, text: str, k: int) -> DataFrame:
    """``(id, n, set_key, sketch, bands)`` of every row: set size, digest of the set, a byte per hash, band hashes."""

    def run(batches):
        shingler = Shingler(k)
        turn = np.random.default_rng(SEED + 1).integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0))
            for begin, end in chunks(sizes, CHUNK):
                part = batch.slice(begin, end - begin)
                sets = shingler.sets(as_bytes(part.column(1)))
                grid = np.stack([shingler.signature(s) for s in sets])
                bands = _mix((grid * turn).reshape(len(sets), BANDS, ROWS).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        pa.array(np.array([len(s) for s in sets], np.int64)),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([row.tobytes() for row in grid.astype(np.uint8)], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, BANDS * len(sets) + 1, BANDS, dtype=np.int32)),
                            pa.array(bands.ravel().view(np.int64)),
                        ),
                    ],
                    ["id", "n", "set_key", "sketch", "bands"],
                )
        del shingler
        pa.default_memory_pool().release_unused()
        give_back()

    schema = "id long, n long, set_key binary, sketch binary, bands array<long>"
    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def least_matches(percent: int, miss: float) -> list[int]:
    """For 0, STEP, 2 * STEP … compared bytes: the least number of equal ones at which a pair stays.

    A byte matches by chance in one of 256 cases. With a uniform prior the posterior of the match
    rate after m of n is Beta(m + 1, n - m + 1); its tail is a sum of binomials.
    """
    rate = percent / 100 + (1 - percent / 100) / 256
    out = []
    for n in range(0, HASHES + 1, STEP):
        terms = [math.comb(n + 1, i) * rate**i * (1 - rate) ** (n + 1 - i) for i in range(n + 2)]
        tail, least = 0.0, n + 1
        for m in range(n + 1):
            tail += terms[m]  # P(rate >= threshold | m of n)
            if tail >= miss:
                least = m
                break
        out.append(least)
    return out


def plausible(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Positions of the pairs ``left[a], right[b]`` that no step of the sequential check drops."""
    at = np.arange(len(a))
    equal = np.zeros(len(a), np.int16)
    for step in range(1, len(least)):
        if not len(at):
            break
        cut = slice((step - 1) * STEP, step * STEP)
        equal = equal + (left[a[at], cut] == right[b[at], cut]).sum(1, dtype=np.int16)
        keep = equal >= least[step]
        at, equal = at[keep], equal[keep]
    return at


def _grid(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), HASHES)


def _checked(pairs: DataFrame, least: list[int], percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of ``(a, b, na, nb, sa, sb)`` that may be linked."""

    def run(batches):
        for batch in batches:
            na, nb = (np.asarray(batch.column(name)) for name in ("na", "nb"))
            fits = np.flatnonzero(np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent)
            at = fits[plausible(_grid(batch.column("sa")), _grid(batch.column("sb")), fits, fits, least)]
            yield batch.select(["a", "b"]).take(pa.array(at))

    return pairs.mapInArrow(run, "a long, b long")


def _searched(rows: DataFrame, least: list[int], percent: int) -> DataFrame:
    """Plausible pairs of different components in each block of ``(bucket, i, j, asks, id, component, n, sketch)``.

    Rows come sorted by block; a block holds some ``BLOCK`` classes that ask and as many that answer.
    All blocks at hand are searched together: row r against row r + 1, then r + 2 and so on.
    """

    def search(part: pa.RecordBatch) -> pa.RecordBatch:
        block = np.stack([np.asarray(part.column(c)) for c in ("bucket", "i", "j")])
        ids, component, n, asks = (np.asarray(part.column(c)) for c in ("id", "component", "n", "asks"))
        sketch = _grid(part.column("sketch"))
        found = []
        at = np.arange(len(ids))
        step = 1
        while True:
            at = at[at + step < len(ids)]
            at = at[(block[:, at] == block[:, at + step]).all(0)]
            if not len(at):
                break
            to = at + step
            fits = (asks[at] != asks[to]) & (component[at] != component[to])
            fits &= np.minimum(n[at], n[to]) * 100 >= np.maximum(n[at], n[to]) * percent
            a = at[fits]
            a = a[plausible(sketch, sketch, a, a + step, least)]
            found.append(np.stack([ids[a], ids[a + step]]))
            step += 1
        pairs = np.concatenate([np.zeros((2, 0), np.int64), *found], 1)
        pairs = np.unique(np.stack([pairs.max(0), pairs.min(0)]), axis=1) if pairs.size else pairs
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return rows.mapInArrow(_by_block(("bucket", "i", "j"), search), "a long, b long")


def _large(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``batch`` with wide offsets: a column of short ones is left in several chunks beyond 2 GiB."""
    wide = {pa.string(): pa.large_string(), pa.binary(): pa.large_binary()}
    return batch.cast(pa.schema([field.with_type(wide.get(field.type, field.type)) for field in batch.schema]))


def _by_block(keys: tuple[str, ...], work):
    """A function over sorted batches that hands ``work`` whole blocks only."""

    def run(batches):
        rest = None
        for batch in batches:
            batch = _large(batch)
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            if not len(table):
                continue
            (whole,) = table.to_batches()
            columns = [np.asarray(whole.column(c)) for c in keys]
            open_ = np.flatnonzero(~np.logical_and.reduce([k == k[-1] for k in columns]))
            cut = int(open_[-1]) + 1 if len(open_) else 0
            if cut:
                yield work(whole.slice(0, cut))
            rest = whole.slice(cut)
        if rest is not None and len(rest):
            yield work(rest)

    return run


def _joined(rows: DataFrame, least: list[int], k: int, percent: int) -> DataFrame:
    """Links found in each block of ``(part, i, j, asks, id, n, sketch, text)``: for each class that asks, the first of
    those that answer whose full set is similar enough."""

    def block(part: pa.RecordBatch, shingler: Shingler) -> list[tuple[int, int]]:
        asks, n, ids = (np.asarray(part.column(c)) for c in ("asks", "n", "id"))
        sketch = _grid(part.column("sketch"))
        answers = np.flatnonzero(~asks)
        held = np.asarray(pa.compute.fill_null(pa.compute.binary_length(part.column("text")), 0))
        found, sets = [], {}

        def full(at):
            new = [i for i in at.tolist() if i not in sets]
            for begin, end in chunks(held[np.array(new, np.int64)], CHUNK):
                some = new[begin:end]
                sets.update(zip(some, shingler.sets(as_bytes(part.column("text").take(pa.array(some)))), strict=True))
            return [sets[i] for i in at.tolist()]

        for one in np.flatnonzero(asks):
            fits = answers[np.minimum(n[one], n[answers]) * 100 >= np.maximum(n[one], n[answers]) * percent]
            fits = fits[plausible(sketch, sketch, np.full(len(fits), one), fits, least)]
            if not len(fits):
                continue
            (own,), others = full(np.array([one])), full(fits)
            every = np.concatenate(others)
            sizes = np.array([len(x) for x in others])
            inside = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
            common = np.add.reduceat(inside.astype(np.int64), np.cumsum(sizes) - sizes)
            good = np.flatnonzero(common * 100 >= percent * (len(own) + sizes - common))
            if len(good):
                found.append((int(ids[one]), int(ids[fits[good[0]]])))
        return found

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        shingler = Shingler(k)
        keys = np.stack([np.asarray(batch.column(c)) for c in ("part", "i", "j")])
        cuts = np.flatnonzero((np.diff(keys, axis=1, prepend=keys[:, :1] - 1) != 0).any(0))
        found = []
        for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(batch)], strict=True):
            found += block(batch.slice(begin, end - begin), shingler)
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(_by_block(("part", "i", "j"), work), "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets are similar enough; ``docs`` has ``id`` and ``text``."""
    pairs = staged(pairs.distinct(), "pairs")
    needed = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "needed")
    texts = docs.join(broadcast_if_small(needed, BROADCAST_IDS), "id", "left_semi")
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches):
        shingler = Shingler(k)
        held, held_set = None, None
        for batch in batches:
            a, b, ta, tb = (batch.column(c) for c in ("a", "b", "ta", "tb"))
            sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(ta), 0))
            good = []
            for begin, end in chunks(sizes, CHUNK):
                sets = shingler.sets(as_bytes(ta.slice(begin, end - begin)))
                for at, one in enumerate(sets, begin):
                    text = tb[at].as_py() or ""
                    if held != text:
                        held, held_set = text, shingler.sets([text.encode()])[0]
                    common = len(np.intersect1d(one, held_set, assume_unique=True))
                    if 0 < common * 100 >= percent * (len(one) + len(held_set) - common):
                        good.append(at)
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).take(pa.array(good, pa.int64()))

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, miss: float = 1e-5
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row; ``kept`` marks the least id of a component."""
    with arrow_rows(docs.sparkSession, BATCH):
        rows, class_of, found = _grouped(docs, id, text, k, percent, miss)
    labels = class_of.join(found.withColumnRenamed("node", "id"), "id", "left")
    labels = labels.select("set_key", F.coalesce("component", "id").alias("component"))
    out = rows.select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("set_key")).alias("set_key"))
    out = out.join(labels, "set_key", "left").select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )
    return out.withColumn("kept", F.col(id).eqNullSafe(F.col("component_id")))


def _grouped(docs: DataFrame, id: str, text: str, k: int, percent: int, miss: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all rows, the class of each set, and the component of each linked class, all stored."""
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = staged(sketches(texts, "id", "text", k), "sketches")
    least = least_matches(percent, miss)
    able = rows.where("n > 0 and id is not null")
    class_of = able.groupBy("set_key").agg(F.min("id").alias("id"))
    classes = staged(able.join(class_of, ["set_key", "id"], "left_semi").select("id", "n", "sketch", "bands"), "classes")

    sides = classes.select("id", "n", "sketch")
    links, found = None, None
    for bands, ends in ROUNDS:
        tried = _stars(_owned(classes, found, bands), ends)
        if found is None:
            tried = tried.groupBy("a").agg(F.min("b").alias("b"))
        tried = tried.join(sides.toDF("a", "na", "sa"), "a").join(sides.toDF("b", "nb", "sb"), "b")
        new = staged(_verified(_checked(tried, least, percent), texts, k, percent).distinct(), "links")
        if links is not None and new.isEmpty():
            continue  # this round ties nothing: the components stay
        links = new if links is None else links.unionByName(new)
        found = staged(components(links), "components")

    outside = staged(_outside(_owned(classes, found, BANDS)), "outside")
    within = _verified(_searched(_blocks(outside, sides), least, percent), texts, k, percent)
    across = _joined(_against(outside, classes, found, sides, texts), least, k, percent)
    new = staged(within.unionByName(across).distinct(), "links")
    if not new.isEmpty():
        found = staged(components(links.unionByName(new)), "components")
    return rows, class_of, found


def _owned(classes: DataFrame, found: DataFrame | None, bands: int) -> DataFrame:
    """``(bucket, id, component)`` of each class in its first ``bands`` buckets."""
    if found is None:
        owned = classes.withColumn("component", F.col("id"))
    else:
        owned = classes.select("id", "bands").join(found.withColumnRenamed("node", "id"), "id", "left")
        owned = owned.withColumn("component", F.coalesce("component", "id"))
    return owned.select("id", "component", F.explode(F.slice("bands", 1, bands)).alias("bucket"))


def _stars(owned: DataFrame, ends: tuple[str, str]) -> DataFrame:
    """Pairs ``(a, b)`` between one class of each component of a bucket and one of its commonest component.

    Which class stands for a component is told by ``ends``: its least id there, or its largest.
    A component is one row per bucket, so a group that is tied together costs no more than one class.
    """
    parts = owned.groupBy("bucket", "component").agg(
        F.min("id").alias("least"), F.max("id").alias("largest"), F.count("*").alias("n")
    )
    mixed = parts.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    parts = staged(parts.join(mixed.select("bucket"), "bucket"), "parts")
    one, other = ends
    top = parts.groupBy("bucket").agg(F.min(F.struct((-F.col("n")).alias("n"), "component", F.col(other).alias("b"))).alias("top"))
    pairs = parts.join(top, "bucket").where(F.col("component") != F.col("top.component"))
    return pairs.select(F.col(one).alias("a"), F.col("top.b").alias("b")).distinct()


def _outside(owned: DataFrame) -> DataFrame:
    """``(bucket, id, component, top)`` of the classes that aren't of their bucket's commonest component ``top``."""
    parts = owned.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    parts = staged(parts.join(mixed.select("bucket"), "bucket"), "parts")
    top = parts.groupBy("bucket").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("component").alias("top"))).alias("x"))
    top = top.select(F.col("bucket").alias("of"), "x.top")
    return owned.join(top, (F.col("bucket") == F.col("of")) & (F.col("component") != F.col("top"))).select("bucket", "id", "component", "top")


def _cut_up(asking: DataFrame, answering: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Blocks of ``BLOCK`` asking by ``BLOCK`` answering rows of each key, sorted; both have ``asked`` and ``answered``,
    the numbers of blocks."""
    place = F.xxhash64("id")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    ask = asking.select("*", F.pmod(place, "asked").cast("int").alias("i"), every("answered").alias("j"), F.lit(True).alias("asks"))
    answer = answering.select("*", every("asked").alias("i"), F.pmod(place, "answered").cast("int").alias("j"), F.lit(False).alias("asks"))
    columns = [key, "i", "j", "asks", *columns]
    both = ask.select(*columns).unionByName(answer.select(*columns))
    return both.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")


def _blocks(outside: DataFrame, sides: DataFrame) -> DataFrame:
    """Classes outside, against each other in their buckets. A pair is met twice, which does no harm."""
    shape = outside.groupBy("bucket").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("asked"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    shape = shape.where("x < y").select("bucket", "asked", F.col("asked").alias("answered"))
    rows = outside.join(shape, "bucket").join(sides, "id")
    return _cut_up(rows, rows, "bucket", ["id", "component", "n", "sketch"])


def _against(outside: DataFrame, classes: DataFrame, found: DataFrame, sides: DataFrame, texts: DataFrame) -> DataFrame:
    """Classes outside, against all of the components ``top`` of their buckets, with the texts."""
    asking = staged(outside.select(F.col("top").alias("part"), "id").distinct(), "asking")
    asked = asking.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("asked"))
    member = classes.select("id").distinct().join(found.withColumnRenamed("node", "id"), "id", "left")
    member = member.select(F.coalesce("component", "id").alias("part"), "id").join(asking.select("part").distinct(), "part", "left_semi")
    member = staged(member, "answering")
    answered = member.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("answered"))
    shape = staged(asked.join(answered, "part"), "shapes")
    needed = staged(asking.select("id").unionByName(member.select("id")).distinct(), "needed")
    full = texts.join(broadcast_if_small(needed, BROADCAST_IDS), "id", "left_semi").join(sides, "id")
    columns = ["id", "n", "sketch", "text"]
    return _cut_up(asking.join(shape, "part").join(full, "id"), member.join(shape, "part").join(full, "id"), "part", columns)
