"""Repair of conversations: cheapest edits that give every conversation the roles ``(system? (user assistant)+)?``.

Rows may be kept, given another role, deleted or joined by inserted empty ones. The cost so far only matters by the state
of a small automaton over the initials of roles, so a conversation is a dynamic program over its rows with one cost vector
a row, of as many numbers as there are states. Of all cheapest edits the ASCII-least string of initials is given: a walk
forward that takes the least letter that keeps the total cheapest ("tight"), which needs the cost of the rest at every row.

Those costs are kept at checkpoints only, one every square root of a conversation's length (``LEAST_BLOCK`` rows at least):

1. every block between two checkpoints becomes a matrix, the cheapest cost from each state at its begin to each at its end,
   by itself, wherever it lies;
2. the matrices of a conversation, as many as the root of its length, are folded from its end to its begin into one cost
   vector a checkpoint;
3. a walk forward reads a conversation's rows in order, recomputes the vectors of one block from the checkpoint at its
   end, emits that block's edits and goes on. It holds one block, whatever the conversation's length; digest of the
   repaired text and audit are written on the way.

Only the walk is bound to one task per conversation, as its digest is one running hash; it streams. Places in
a conversation come from ranges of the whole table, duplicates from an aggregate of digests, so neither asks for a conversation
as a group.

Null ids are a conversation of their own. Null roles and texts count as one space. Rows of one turn are ordered by a digest
of role and text, so repeated ones stand together. An empty role gives no initial, so keeping it leaves the state as it
is. A conversation without rows has nothing to repair: no counts, no cost, an empty audit. An empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import staged
from ledgerline.llm.positions import numbered

BLANKS = " \t\n\x0b\x0c\r"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Start, after system, after user, after assistant; the first and the last may be the end.
STATES = range(4)
ENDS = (0, 3)
USER, ASSISTANT = "user", "assistant"
#: The role an inserted or renamed row has to have in each state, and the state it leads to.
WANTED = {0: USER, 1: USER, 2: ASSISTANT, 3: USER}
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
NEVER = 1 << 60
LEAST_BLOCK = 256

Row = tuple[str, int]  # a role's initial, a fault


def _kept(state: int, initial: str) -> int | None:
    """State after a row that is kept."""
    if not initial:
        return state
    if initial == "s":
        return 1 if state == 0 else None
    return NEXT[state] if initial == WANTED[state][0] else None


def _closed(costs: list[int]) -> list[int]:
    """Costs of the rest with insertions before it."""
    costs = list(costs)
    for _ in STATES:
        for state in STATES:
            costs[state] = min(costs[state], INSERT + costs[NEXT[state]])
    return costs


def _edits(state: int, row: Row) -> list[tuple[str, int, int]]:
    """Initial, cost and next state of what can be done to a row, by the initial."""
    initial, fault = row
    out = [("D", DELETE, state)]
    if fault in (BLANK, DUPLICATE):
        return out
    more = UNFINISHED if fault == TRUNCATED else 0
    to = _kept(state, initial)
    if to is not None:
        out.append(("K", more, to))
    out.append(("R", REROLE + more, NEXT[state]))
    return out


def _before(row: Row, after: list[int]) -> list[int]:
    """Costs of the rest from a row on, from those after it."""
    return _closed([min(cost + after[to] for _, cost, to in _edits(state, row)) for state in STATES])


def _at_end() -> list[int]:
    return _closed([0 if state in ENDS else NEVER for state in STATES])


def _vectors(rows: list[Row], after: list[int]) -> list[list[int]]:
    """Costs of the rest before each row of a block, and after its last one."""
    out = [after]
    for row in reversed(rows):
        out.append(_before(row, out[-1]))
    return out[::-1]


def _matrix(rows: list[Row]) -> list[int]:
    """Cheapest costs of a block from each state at its begin to each at its end, row by row of the begin."""
    columns = []
    for end in STATES:
        columns.append(_vectors(rows, [0 if state == end else NEVER for state in STATES])[0])
    return [min(columns[end][state], NEVER) for state in STATES for end in STATES]


def _folded(matrix: list[int], after: list[int]) -> list[int]:
    return [min(matrix[4 * state + end] + after[end] for end in STATES) for state in STATES]


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, turn, role, text, copy)`` with planted damage: by the key's checksum, of twenty parts one each is dropped,
    emptied, robbed of its final stops, repeated, or given to the user."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.concat(spaced(conv), F.lit(":"), spaced(turn))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(spaced(text), ".!?", "")).otherwise(spaced(text))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, F.lit(USER)).otherwise(spaced(role)).alias("role"),
        text.alias("text"),
        F.explode(F.when(kind == 0, F.array().cast("array<int>")).otherwise(copies)).alias("copy"),
    )
    return rows


def _fault(first: Column) -> Column:
    """The first fault of a row; ``first`` tells whether its role and text weren't seen before in the conversation."""
    body = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(body == "", F.lit(BLANK)).when(~first, F.lit(DUPLICATE))
    return fault.when(~F.right(body, F.lit(1)).isin(".", "!", "?"), F.lit(TRUNCATED)).otherwise(F.lit(SOUND))


def _streams(batches, columns: list[str]) -> Iterator[tuple]:
    """Rows of sorted batches, one after another."""
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns], strict=True)


def _matrices(rows: DataFrame) -> DataFrame:
    """``(tree, block, matrix)`` of each block of sorted ``rows(tree, block, pos, initial, fault)``."""

    def run(batches):
        held, own, out = [], None, []
        for tree, block, initial, fault in _streams(batches, ["tree", "block", "initial", "fault"]):
            if (tree, block) != own and held:
                out.append((*own, _matrix(held)))
                held = []
            own = (tree, block)
            held.append((initial, fault))
        if held:
            out.append((*own, _matrix(held)))
        trees, blocks, matrices = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(trees, pa.string()), pa.array(blocks, pa.int64()), pa.array(matrices, pa.list_(pa.int64()))], ["tree", "block", "matrix"]
        )

    return rows.mapInArrow(run, "tree string, block long, matrix array<long>")


def _checkpoints(matrices: DataFrame) -> DataFrame:
    """``(tree, block, last, after)``: costs of the rest after each block of sorted ``matrices``, last block first."""

    def run(batches):
        own, after = None, None
        for batch in batches:
            out = []
            for tree, block, matrix in _streams([batch], ["tree", "block", "matrix"]):
                last = tree != own
                if last:
                    own, after = tree, _at_end()
                out.append((tree, block, last, after))
                after = _folded(matrix, after)
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["tree", "block", "last", "after"])

    return matrices.mapInArrow(run, "tree string, block long, last boolean, after array<long>")


class Walk:
    """One conversation on its way forward: state, counts, edits and digest so far."""

    def __init__(self, conv):
        self.conv = conv
        self.state, self.cost = 0, 0
        self.audit: list[str] = []
        self.digest, self.some = sha256(), False
        self.faults = [0, 0, 0, 0]
        self.illegal, self.initial = 0, None
        self.least = self.largest = None
        self.turns = 0

    def _write(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.some else ''}{role}:{text}".encode())
        self.some = True

    def _insert(self, letters: list[str]) -> None:
        self.cost += INSERT
        letters.append("I")
        self._write(WANTED[self.state], "")
        self.state = NEXT[self.state]

    def block(self, rows: list[tuple], after: list[int], last: bool) -> None:
        """Go on over ``(turn, role, text, fault)`` rows; ``after`` are the costs of the rest behind them."""
        costs = _vectors([(role[:1], fault) for _, role, _, fault in rows], after)
        letters: list[str] = []
        for at, (turn, role, text, fault) in enumerate(rows):
            self._count(turn, role, fault)
            while True:
                letter, cost, to = self._least(role, fault, costs[at], costs[at + 1])
                if letter != "I":
                    break
                self._insert(letters)
            self.cost += cost
            letters.append(letter)
            if letter != "D":
                self._write(WANTED[self.state] if letter == "R" else role, text)
            self.state = to
        while last and after[self.state]:
            self._insert(letters)
        self.audit.append("".join(letters))

    def _least(self, role: str, fault: int, here: list[int], after: list[int]) -> tuple[str, int, int]:
        """The least letter that loses nothing: D, I, K, R."""
        rest = here[self.state]
        choices = _edits(self.state, (role[:1], fault))
        choices.insert(1, ("I", INSERT, NEXT[self.state]))
        return next(c for c in choices if c[1] + (here if c[0] == "I" else after)[c[2]] == rest)

    def _count(self, turn, role: str, fault: int) -> None:
        self.faults[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if turn is not None:
            self.turns += turn != self.largest
            self.least = turn if self.least is None else self.least
            self.largest = turn

    def row(self) -> tuple:
        gaps = self.largest - self.least + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


REPAIRED = {
    "conv": "long",
    "gaps": "long",
    "blank": "long",
    "duplicate": "long",
    "truncated": "long",
    "illegal": "long",
    "cost": "long",
    "audit": "string",
    "repaired_sha256": "string",
}
#: Kinds of rows in a walk, in order: a conversation begins, costs after a block, a row.
BEGIN, COSTS, ROW = range(3)
WALKED = ["tree", "conv", "kind", "last", "turn", "role", "text", "fault", "after"]


def _walked(rows: DataFrame) -> DataFrame:
    """One row a conversation of sorted ``rows``."""

    def run(batches):
        walk, held, after, last = None, [], None, True
        for batch in batches:
            out = []
            for tree, conv, kind, final, turn, role, text, fault, costs in _streams([batch], WALKED):
                if kind == ROW:
                    held.append((turn, role, text, fault))
                    continue
                if walk is not None and held:
                    walk.block(held, after, last)
                held = []
                if kind == BEGIN:
                    if walk is not None:
                        out.append(walk.row())
                    walk, after, last = Walk(conv), _at_end(), True
                else:
                    after, last = costs, final
            if out:
                yield _table(out)
        if walk is not None:
            if held:
                walk.block(held, after, last)
            yield _table([walk.row()])

    return rows.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in REPAIRED.items()))


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(columns, REPAIRED.values(), strict=True)], list(REPAIRED))


def repair(rows: DataFrame, convs: DataFrame, least_block: int = LEAST_BLOCK) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every id of ``convs(conv)``.

    ``rows`` are ``(conv, turn, role, text, copy)`` without null roles or texts; ``copy`` orders equal rows of a turn.
    """
    tree = lambda: F.coalesce(F.col("conv").cast("string"), F.lit("")).alias("tree")
    rows = rows.select(tree(), "conv", "turn", "role", "text", "copy")
    rows = rows.withColumn("mark", F.md5(F.concat("role", F.lit("\0"), "text").cast("binary")))
    placed = staged(numbered(rows, "tree", ["turn", "mark", "copy"], "turns"), "turns")
    again = placed.groupBy("tree", "mark").agg(F.min("pos").alias("first"), F.max("pos").alias("end")).where("first < end")
    placed = placed.join(again.drop("end"), ["tree", "mark"], "left")
    width = F.greatest(F.lit(least_block), F.ceil(F.sqrt("n"))).cast("long")
    placed = placed.select(
        "tree",
        "conv",
        "pos",
        F.floor(F.col("pos") / width).cast("long").alias("block"),
        (F.col("n") > width).alias("cut"),
        "turn",
        "role",
        "text",
        _fault(F.coalesce(F.col("pos") == F.col("first"), F.lit(True))).alias("fault"),
    )
    placed = staged(placed, "faults")
    long_ = placed.where("cut").select("tree", "block", "pos", F.left("role", F.lit(1)).alias("initial"), "fault")
    matrices = _matrices(long_.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos"))
    checkpoints = _checkpoints(matrices.repartition("tree").sortWithinPartitions("tree", F.desc("block")))

    nothing = {"conv": "long", "turn": "long", "role": "string", "text": "string", "fault": "int", "after": "array<long>", "pos": "long"}
    keys = ["tree", "block", "kind", "pos"]

    def kind_of(kind: int, df: DataFrame) -> DataFrame:
        """``df`` with all columns of a walk."""
        df = df.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items() if c not in df.columns})
        return df.withColumn("kind", F.lit(kind)).select(*keys, *[c for c in WALKED if c not in keys])

    begins = convs.select(tree(), F.col("conv").cast("long").alias("conv"), F.lit(-1).cast("long").alias("block"), F.lit(True).alias("last"))
    every = kind_of(BEGIN, begins.distinct()).unionByName(kind_of(COSTS, checkpoints)).unionByName(kind_of(ROW, placed.withColumn("last", F.lit(True))))
    return _walked(every.repartition("tree").sortWithinPartitions(*keys))
