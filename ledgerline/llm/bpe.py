"""Byte-level BPE: texts to token ids and back.

A text is cut by the vocabulary's pattern; every piece is merged on its own. Pieces not
seen before are gathered per chunk of rows, put into matrices of similar length and
merged together: each round, every row of a matrix joins its leftmost pair of least rank.
Rows without a pair left are taken out, the others close up by one column.

Null texts encode as empty. Any row gives one row, repeated rows too; an empty table gives
an empty table. Columns of the input that carry an output's name are replaced.
"""

from __future__ import annotations

import base64
import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (as pa.compute)
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerline.llm.common import without

NONE = np.int32(2**31 - 1)
#: Pieces beyond this many bytes are merged with a heap: one matrix row of n bytes costs n * n.
LONG_PIECE = 256
#: Entries of a worker's memory of pieces; it starts anew when full, which changes no result.
REMEMBERED = 60_000
#: Bytes of text that are cut and merged together.
CHUNK = 1 << 20


class Vocabulary:
    """Ranks of byte strings, and the pairs that join into them."""

    def __init__(self, lines: bytes, pattern: str):
        ranks = {}
        for line in lines.splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.cut = regex.compile(pattern).findall
        self.double_space = re.compile(r"\s\s").search
        self.first = np.full(256, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 1:
                self.first[token[0]] = rank
        if (self.first < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.fromiter(map(len, tokens), np.int64, size)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.known = np.fromiter((bool(t) for t in tokens), bool, size)
        pairs = {}
        for token, rank in ranks.items():
            for at in range(1, len(token)):
                left, right = ranks.get(token[:at]), ranks.get(token[at:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self._hash_pairs(pairs)
        self.pieces: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    def _hash_pairs(self, pairs: dict[int, int]) -> None:
        """Open addressing; at most a quarter of the slots is filled."""
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        for key, value, slot in zip(keys.tolist(), pairs.values(), self._slots(keys).tolist(), strict=True):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.keys[slot], self.values[slot] = key, value

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of what two tokens join into; NONE if nothing, or if one is padding (-1)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while open_.size:
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = 4
        below = 0
        while below < LONG_PIECE:
            chosen = np.flatnonzero((lengths > below) & (lengths <= width))
            step = max(1, (1 << 20) // width)
            for at in range(0, len(chosen), step):
                self._merge_bucket(words, lengths, chosen[at : at + step], width, out)
            below, width = width, width * 2
        for at in np.flatnonzero(lengths > LONG_PIECE):
            out[at] = self._merge_long(words[at])
        return out

    def _merge_bucket(self, words, lengths, chosen, width, out) -> None:
        raw = b"".join([words[i].ljust(width, b"\0") for i in chosen])
        grid = self.first[np.frombuffer(raw, np.uint8)].reshape(-1, width)
        left = lengths[chosen]
        grid[np.arange(width) >= left[:, None]] = -1
        rows = chosen
        ranks = self.joined(grid[:, :-1].ravel(), grid[:, 1:].ravel()).reshape(len(rows), -1)
        while len(rows):
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NONE)
            live = best != NONE
            if not live.all():
                for row, ids, n in zip(rows[~live].tolist(), grid[~live], left[~live].tolist(), strict=True):
                    out[row] = ids[:n].tobytes()
                grid, ranks, rows, left, at, best = grid[live], ranks[live], rows[live], left[live], at[live], best[live]
                if not len(rows):
                    return
            every = np.arange(len(rows))
            grid[every, at] = best
            columns = np.arange(grid.shape[1] - 1)
            beyond = columns > at[:, None]
            grid = np.where(beyond, grid[:, 1:], grid[:, :-1])
            ranks = np.where(beyond[:, :-1], ranks[:, 1:], ranks[:, :-1])
            left = left - 1
            if ranks.shape[1]:
                right = at < ranks.shape[1]
                ranks[every[right], at[right]] = self.joined(best[right], grid[every[right], at[right] + 1])
                before = at > 0
                ranks[every[before], at[before] - 1] = self.joined(grid[every[before], at[before] - 1], best[before])

    def _merge_long(self, word: bytes) -> bytes:
        """The same merges by a heap over a linked list: least rank first, then leftmost."""
        ids = self.first[np.frombuffer(word, np.uint8)]
        ranks = self.joined(ids[:-1], ids[1:])
        n = len(ids)
        ids = ids.tolist()
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(int(r), i) for i, r in enumerate(ranks.tolist()) if r != NONE]
        heapq.heapify(heap)
        wanted = dict((i, r) for r, i in heap)

        def look(i):
            j = after[i]
            rank = self._pair(ids[i], ids[j]) if j < n else int(NONE)
            if rank != NONE:
                wanted[i] = rank
                heapq.heappush(heap, (rank, i))
            else:
                wanted.pop(i, None)

        while heap:
            rank, i = heapq.heappop(heap)
            if not alive[i] or wanted.get(i) != rank:
                continue
            j = after[i]
            ids[i], alive[j], after[i] = rank, False, after[j]
            wanted.pop(j, None)
            if after[i] < n:
                before[after[i]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        return np.array([x for x, a in zip(ids, alive, strict=True) if a], "<i4").tobytes()

    def _pair(self, left: int, right: int) -> int:
        key = left << 32 | right
        slot = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - self.bits)
        while (found := int(self.keys[slot])) >= 0:
            if found == key:
                return int(self.values[slot])
            slot = (slot + 1) & ((1 << self.bits) - 1)
        return int(NONE)

    def _learn(self, spaced: set[str], pieces: set[str]) -> None:
        """Fill both memories. A space between two other characters always starts a piece,
        so what follows one is cut the same wherever it stands."""
        if len(self.spaced) > REMEMBERED:
            self.spaced.clear()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        cuts = {word: self.cut(" " + word) for word in spaced if word not in self.spaced}
        for parts in cuts.values():
            pieces.update(parts)
        new = [piece for piece in pieces if piece not in self.pieces]
        merged = self.merge([piece.encode() for piece in new])
        self.pieces.update(zip(new, merged, strict=True))
        self.spaced.update((word, b"".join([self.pieces[p] for p in parts])) for word, parts in cuts.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        cut, spaced, pieces = [], set(), set()
        for text in texts:
            if self.double_space(text) or text[:1].isspace() or text[-1:].isspace():
                head, tail = self.cut(text), []
            else:
                words = text.split(" ")
                head, tail = self.cut(words[0]), words[1:]
            pieces.update(head)
            spaced.update(tail)
            cut.append((head, tail))
        self._learn(spaced, pieces)
        one, two = self.pieces.__getitem__, self.spaced.__getitem__
        return [b"".join(map(one, head)) + b"".join(map(two, tail)) for head, tail in cut]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in one run, and the number of bytes of each id."""
        if ids.size and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if ids.size else 0
        at = np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(total)
        return self.blob[at], lengths


@lru_cache(maxsize=4)
def vocabulary(lines: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(lines, pattern)


def chunks(sizes: np.ndarray, most: int):
    """Ranges of rows of about ``most`` bytes each."""
    begin, total = 0, 0
    for at, size in enumerate(sizes.tolist()):
        total += size
        if total >= most:
            yield begin, at + 1
            begin, total = at + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of their texts, as an array of integers.

    ``ranks_path`` is a rank file on the driver (token in base64, rank); it travels with the job.
    """
    with open(ranks_path, "rb") as file:
        lines = file.read()
    kept = without(docs, ids)
    place = kept.columns.index(text)

    def run(batches):
        vocab = vocabulary(lines, pattern)
        for batch in batches:
            column = batch.column(place)
            sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0))
            for begin, end in chunks(sizes, CHUNK):
                part = batch.slice(begin, end - begin)
                texts = [t or "" for t in part.column(place).to_pylist()]
                found = vocab.encode(texts)
                ends = np.cumsum([0] + [len(x) // 4 for x in found])
                flat = pa.array(np.frombuffer(b"".join(found), "<i4"))
                out = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)
                yield pa.RecordBatch.from_arrays([*part.columns, out], [*part.schema.names, ids])

    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return kept.mapInArrow(run, schema)


def decode(docs: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the bytes their ids stand for; an unknown id ends the job, null ids give empty bytes."""
    with open(ranks_path, "rb") as file:
        lines = file.read()
    kept = without(docs, decoded)
    place = kept.columns.index(ids)

    def run(batches):
        vocab = vocabulary(lines, pattern)
        for batch in batches:
            sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(batch.column(place)), 0))
            for begin, end in chunks(sizes, CHUNK // 4):
                part = batch.slice(begin, end - begin)
                counts = sizes[begin:end]
                flat = np.asarray(part.column(place).flatten())
                data, lengths = vocab.decode(flat)
                bounds = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
                buffers = [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
                out = pa.Array.from_buffers(pa.binary(), len(part), buffers)
                yield pa.RecordBatch.from_arrays([*part.columns, out], [*part.schema.names, decoded])

    schema = T.StructType([*kept.schema.fields, T.StructField(decoded, T.BinaryType())])
    return kept.mapInArrow(run, schema)


