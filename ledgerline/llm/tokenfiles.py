"""Token-id files in key order, and constant-time access to them by a minimal perfect hash.

``write`` lays texts down as token ids in ascending key order. The files below ``path/shards`` hold one row
per shard of some ``SHARD_BYTES``: its place (``part``, ``block``), the keys, the number of ids of each
document, and ``payload``: all ids back to back, little-endian, ``width`` bytes each.

``path/index`` holds one row per bucket of keys: bit arrays that form a minimal perfect hash, and in the order
of its slots a 32-bit fingerprint of the key and the place of the document. A look-up hashes the
key to its bucket and slot and compares the fingerprint: no search, whatever the number of documents.
A key that was never stored passes for another with a probability of 2**-32.

Keys are integers. A key that repeats has one entry for each ``copy``, counted from 0 in the order of texts.
Rows with a null key are stored first and can't be looked up. Null texts are empty. An empty table
gives files without rows.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (as pa.compute)
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.bpe import chunks
from ledgerline.llm.neardup import _mix as mix

SHARD_BYTES = 4 << 20
CHUNK = 8 << 20
#: Keys of one bucket of the index, about.
BUCKET = 50_000
#: Bits of each level for every key left; a level settles the keys that meet no other.
SPREAD = 2
REMEMBERED = 800_000
#: Fixed value: how the vocabulary marks the last token of a word.
WORD_END = "</w>"
LETTERS_AND_SIGNS = re.compile(r"([^\W\d_]+)([!-/:-@\[-^`{-~]+)").fullmatch
SEEDS = np.random.default_rng(99).integers(0, 2**63, 256, np.uint64)

SHARD = "part int, block int, first_key long, width int, keys array<bigint>, copies array<int>, counts array<int>, payload binary"
PLACE = np.dtype([("part", "<i4"), ("block", "<i4"), ("at", "<i4"), ("n", "<i4")])


class Encoder:
    """Ids of texts, by way of the ids of their words.

    The vocabulary drops white space before it merges, so a text's ids are those of its words in turn.
    """

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.known: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of words. Words of letters alone have one end mark each, so they are encoded
        together; letters followed by signs are two words to the vocabulary."""
        cut = {w: m.groups() for w in new if not w.isalpha() and (m := LETTERS_AND_SIGNS(w)) and m[1].lower().isalpha()}
        wanted = {p for pair in cut.values() for p in pair if p not in self.known}
        wanted.update(w for w in new if w not in cut)
        letters = [w for w in wanted if w.isalpha() and w.lower().isalpha()]
        for begin in range(0, len(letters), 1000):
            some = letters[begin : begin + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.dtype)
            ends = (np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize
            if len(ends) == len(some):
                raw, last = ids.tobytes(), 0
                for word, end in zip(some, ends.tolist(), strict=True):
                    self.known[word] = raw[last:end]
                    last = end
        rest = [w for w in wanted if w not in self.known]
        for begin in range(0, len(rest), 1000):
            self._learn_by_place(rest[begin : begin + 1000])
        self.known.update((w, self.known[a] + self.known[b]) for w, (a, b) in cut.items())

    def _learn_by_place(self, some: list[str]) -> None:
        """Words of any kind, encoded together: an id belongs to the word in which its token begins."""
        found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
        first = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
        starts = np.cumsum([0, *(len(w) + 1 for w in some)])
        at = (np.searchsorted(first, starts) * self.dtype.itemsize).tolist()
        raw = np.array(found.ids, self.dtype).tobytes()
        self.known.update((w, raw[a:b]) for w, a, b in zip(some, at[:-1], at[1:], strict=True))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text; a null text has none. Words are told apart once, and their ids gathered by place."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        blank = pa.compute.replace_substring_regex(pa.compute.fill_null(column, ""), "[\n\t\r]", " ")
        words = pa.compute.split_pattern(blank, " ")
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self._learn([w for w in distinct if w not in self.known])
        own = list(map(self.known.__getitem__, distinct))
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // self.dtype.itemsize
        ids = np.frombuffer(b"".join(own), self.dtype)
        which = coded.indices.to_numpy(zero_copy_only=False)
        runs = sizes[which]
        ends = np.cumsum(np.concatenate([[0], runs]))
        shift = (np.cumsum(sizes) - sizes)[which] - ends[:-1]
        raw = ids[np.repeat(shift, runs) + np.arange(ends[-1])].tobytes()
        offsets = words.offsets.to_numpy()
        at = (ends[offsets - offsets[0]] * self.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


@lru_cache(maxsize=2)
def encoder(text: str) -> Encoder:
    return Encoder(text)


def write(docs: DataFrame, path: str, tokenizer: str, end: int, id: str = "doc_id", text: str = "text") -> None:
    """Token files of ``docs`` below ``path``, and their index. ``tokenizer`` is a file on the driver; ``end`` closes each document."""
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()

    def run(batches):
        own = encoder(model)
        closing = np.array([end], own.dtype).tobytes()
        part, block, last, copy = TaskContext.get().partitionId(), 0, None, 0
        keys, copies, counts, payload, size = [], [], [], [], 0

        def shard():
            row = {"part": part, "block": block, "first_key": keys[0], "width": own.dtype.itemsize, "keys": keys, "copies": copies}
            return pa.RecordBatch.from_pylist([row | {"counts": counts, "payload": b"".join(payload)}], schema)

        for batch in batches:
            sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0))
            for begin, stop in chunks(sizes, CHUNK):
                some = batch.slice(begin, stop - begin)
                for key, ids in zip(some.column(0).to_pylist(), own.encode(some.column(1)), strict=True):
                    copy = copy + 1 if counts_on(key, last) else 0
                    last = key
                    keys.append(key)
                    copies.append(copy)
                    counts.append(len(ids) // own.dtype.itemsize + 1)
                    payload += [ids, closing]
                    size += len(ids) + len(closing)
                    if size >= SHARD_BYTES:
                        yield shard()
                        block += 1
                        keys, copies, counts, payload, size = [], [], [], [], 0
        if keys:
            yield shard()

    schema = pa.schema(
        [
            ("part", pa.int32()), ("block", pa.int32()), ("first_key", pa.int64()), ("width", pa.int32()), ("keys", pa.list_(pa.int64())),
            ("copies", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("payload", pa.binary()),
        ]
    )
    rows = docs.select(F.col(id).cast("long").alias("key"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    ordered.mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(f"{path}/shards")
    _write_index(docs.sparkSession, path)


def counts_on(key, last) -> bool:
    """The key repeats the one before it; null keys are all alone."""
    return key is not None and key == last


class PerfectHash:
    """Places the keys of one bucket in slots 0 … n - 1, one key each.

    A level is a bit array; keys that meet no other there are settled by it, the rest go on to the
    next level. A key's slot is the number of set bits before its own, over all levels.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.ranks = np.cumsum(bits) - bits
        self.offsets = np.cumsum([0, *sizes])

    @staticmethod
    def position(keys: np.ndarray, copies: np.ndarray, level: int, size: int) -> np.ndarray:
        once = mix(keys.astype(np.uint64) ^ SEEDS[2 * level])
        return (mix(once + copies.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ SEEDS[2 * level + 1]) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, copies: np.ndarray) -> PerfectHash:
        sizes, parts = [], []
        while len(keys):
            if 2 * len(sizes) + 3 >= len(SEEDS):
                raise ValueError("keys repeat")
            size = -(-SPREAD * len(keys) // 8) * 8
            at = cls.position(keys, copies, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(alone)
            sizes.append(size)
            keys, copies = keys[~alone[at]], copies[~alone[at]]
        return cls(sizes, np.concatenate(parts) if parts else np.zeros(0, bool))

    def slots(self, keys: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level has its bit."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = self.offsets[level] + self.position(keys[open_], copies[open_], level, size)
            hit = self.bits[at]
            out[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit]
        return out


def fingerprints(keys: np.ndarray, copies: np.ndarray) -> np.ndarray:
    mixed = mix(mix(keys.astype(np.uint64) ^ SEEDS[-1]) + copies.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return (mixed >> np.uint64(32)).astype("<u4")


def _bucket(buckets) -> F.Column:
    return F.pmod(F.xxhash64("key", "copy"), buckets).cast("int")


def _write_index(spark: SparkSession, path: str) -> None:
    shards = spark.read.parquet(f"{path}/shards").select("part", "block", "keys", "copies", "counts")
    total = shards.agg(F.sum(F.size("keys"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))
    ends = F.transform("counts", lambda n, i: F.struct(F.get("keys", i).alias("key"), F.get("copies", i).alias("copy"), n.alias("n")))
    rows = shards.select("part", "block", F.posexplode(ends).alias("place", "doc")).select("part", "block", "place", "doc.*")
    rows = rows.where("key is not null").withColumn("bucket", _bucket(F.lit(buckets)))

    def build(key, rows: pd.DataFrame) -> pd.DataFrame:
        keys, copies = rows["key"].to_numpy(np.int64), rows["copy"].to_numpy(np.int64)
        table = PerfectHash.build(keys, copies)
        order = np.argsort(table.slots(keys, copies))
        places = np.zeros(len(rows), PLACE)
        for name, column in (("part", "part"), ("block", "block"), ("at", "place"), ("n", "n")):
            places[name] = rows[column].to_numpy()[order]
        return pd.DataFrame(
            {
                "bucket": [key[0]],
                "buckets": [buckets],
                "sizes": [table.sizes],
                "bits": [np.packbits(table.bits).tobytes()],
                "fingerprints": [fingerprints(keys, copies)[order].tobytes()],
                "places": [places.tobytes()],
            }
        )

    index = "bucket int, buckets long, sizes array<int>, bits binary, fingerprints binary, places binary"
    rows.groupBy("bucket").applyInPandas(build, index).write.parquet(f"{path}/index")


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``(key, copy, part, block, place, n)`` of those of ``keys(key, copy)`` that are stored; repeated keys count once.

    ``place`` is the document's rank in its shard, ``n`` its number of ids.
    """
    index = spark.read.parquet(f"{path}/index")
    first = index.select("buckets").first()
    asked = keys.select(F.col("key").cast("long"), F.col("copy").cast("int")).where("key is not null and copy is not null").distinct()
    asked = asked.withColumn("bucket", _bucket(F.lit(first.buckets if first else 1)))

    def probe(_, rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        columns = {"key": np.int64, "copy": np.int32, "part": np.int32, "block": np.int32, "place": np.int32, "n": np.int32}
        if not len(rows) or not len(asks):
            return pd.DataFrame({c: np.zeros(0, t) for c, t in columns.items()})
        row = rows.iloc[0]
        sizes = [int(n) for n in row["sizes"]]
        table = PerfectHash(sizes, np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: sum(sizes)].astype(bool))
        own, copies = asks["key"].to_numpy(np.int64), asks["copy"].to_numpy(np.int64)
        slots = table.slots(own, copies)
        good = slots >= 0
        good[good] = np.frombuffer(row["fingerprints"], "<u4")[slots[good]] == fingerprints(own[good], copies[good])
        places = np.frombuffer(row["places"], PLACE)[slots[good]]
        values = [own[good], copies[good], places["part"], places["block"], places["at"], places["n"]]
        return pd.DataFrame({c: v.astype(t) for (c, t), v in zip(columns.items(), values, strict=True)})

    grouped = asked.groupBy("bucket").cogroup(index.groupBy("bucket"))
    return grouped.applyInPandas(lambda k, a, b: probe(k, b, a), "key long, copy int, part int, block int, place int, n int")


def _cut(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["payload"], f"<u{row['width']}")
    return ids, np.cumsum([0, *row["counts"]])


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """``(part, block, place, key, at, n, crc32)`` of every stored document, from the payloads: where it begins in its
    shard, its number of ids, and the checksum of its ids as little-endian 32-bit integers."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, ends = _cut(row)
                raw = ids.astype("<u4").tobytes()
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                n = len(sums)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["block"], np.int32)), pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(row["keys"], pa.int64()), pa.array(ends[:-1].astype(np.int64)), pa.array(np.diff(ends).astype(np.int64)), pa.array(np.array(sums, np.int64)),
                    ],
                    ["part", "block", "place", "key", "at", "n", "crc32"],
                )

    shards = spark.read.parquet(f"{path}/shards").select("part", "block", "width", "keys", "counts", "payload")
    return shards.mapInArrow(run, "part int, block int, place int, key long, at long, n long, crc32 long")


def fetch(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``(key, copy, ids)`` of those of ``keys(key, copy)`` that are stored; only shards that hold one are read."""
    found = lookup(spark, path, keys)
    shards = spark.read.parquet(f"{path}/shards").select("part", "block", "width", "counts", "payload")
    shards = shards.join(found.select("part", "block").distinct(), ["part", "block"], "left_semi")

    def take(_, asks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        ids, ends = _cut(rows.iloc[0].to_dict())
        own = [ids[ends[p] : ends[p + 1]].astype(np.int32) for p in asks["place"]]
        return pd.DataFrame({"key": asks["key"], "copy": asks["copy"], "ids": own})

    both = found.groupBy("part", "block").cogroup(shards.groupBy("part", "block"))
    return both.applyInPandas(take, "key long, copy int, ids array<int>")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """``(part, block, begin)``: ids of all shards before each. Only one row per part is put in order as a whole."""
    shards = spark.read.parquet(f"{path}/shards").select("part", "block", F.aggregate("counts", F.lit(0).cast("long"), lambda s, n: s + n).alias("n"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = shards.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", (F.sum("n").over(before) - F.col("n")).alias("base"))
    shards = shards.select("part", "block", (F.sum("n").over(within) - F.col("n")).alias("own"))
    return shards.join(parts, "part").select("part", "block", (F.col("base") + F.col("own")).alias("begin"))
