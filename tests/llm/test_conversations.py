"""Against a search over all edits, cheapest first, that knows nothing of states."""

import heapq
import random
import re
from hashlib import sha256
from zlib import crc32

import pytest

from ledgerline.llm import conversations, shape_queries  # noqa: F401
from ledgerline.llm.registry import QUERIES

WHOLE = re.compile("(s?(ua)+)?")
PART = re.compile("s?(ua)*u?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows, faults):
    """Least (cost, audit) and the repaired lines."""
    todo = [(0, "", 0, "", ())]
    seen = set()
    while todo:
        cost, audit, at, initials, lines = heapq.heappop(todo)
        if at == len(rows) and WHOLE.fullmatch(initials):
            return cost, audit, lines
        # what is legal from here on depends on the parity of the end and on whether anything came before
        mark = at, initials[-1:], len(initials) > 0
        if mark in seen:
            continue
        seen.add(mark)

        def go(more, letter, to, line):
            now = initials + (line[0][:1] if line else "")
            if PART.fullmatch(now):
                new = lines + ((f"{line[0]}:{line[1]}",) if line else ())
                heapq.heappush(todo, (cost + more, audit + letter, to, now, new))

        for role in ("user", "assistant"):
            go(3, "I", at, (role, ""))
        if at < len(rows):
            role, text = rows[at]
            more = 3 if faults[at] == "truncated" else 0
            go(4, "D", at + 1, None)
            if faults[at] not in ("blank", "duplicate"):
                go(more, "K", at + 1, (role, text))
                for new in ("user", "assistant"):
                    go(3 + more, "R", at + 1, (new, text))
    raise AssertionError


def brute(rows, broken):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in broken if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        faults, seen = [], set()
        for _, role, text in mine:
            end = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "sound" if end[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, lines = cheapest([r[1:] for r in mine], faults)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_query_on_the_small_tables(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert result(QUERIES["op12_conversation_repair"](spark, folder)) == brute(rows, damage(rows))


@pytest.fixture(scope="module")
def odd():
    pick = random.Random(9)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None]
    texts = ["Yes.", "No!", "What? ", "cut off", "", " \t\n", None, "Long " * 50 + "."]
    rows = [(c, t, pick.choice(roles), pick.choice(texts)) for c in range(60) for t in range(pick.randrange(1, 12))]
    rows += [(100, None, "user", "Hello."), (100, 3, "assistant", "So."), (None, 1, "user", "A."), (None, None, None, None)]
    rows += [(101, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(300)]
    return rows


def test_odd_rows_and_blocks_of_every_size(spark, odd):
    table = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")
    broken = conversations.damaged(table, "conv_id", "turn", "role", "text")
    want = brute(odd, damage(odd))
    for least_block in (1, 3, 256):
        assert result(conversations.repair(broken, table.selectExpr("conv_id as conv"), least_block)) == want


def test_nothing_left_empty_roles_and_clashing_names(spark):
    gone = next(i for i in range(1000) if crc32(f"{i}:0".encode()) % 20 == 0)
    kept = next(i for i in range(1000) if crc32(f"{i}:0".encode()) % 20 > 4)
    table = spark.createDataFrame([(gone, 0, "user", "x."), (kept, 0, "", "x.")], "conv_id long, turn long, role string, text string")
    table = table.selectExpr("*", "1 as n", "2 as pos", "3 as tree", "4 as fault")
    broken = conversations.damaged(table, "conv_id", "turn", "role", "text")
    got = result(conversations.repair(broken, table.selectExpr("conv_id as conv")))
    empty = sha256(b"").hexdigest()
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", empty)
    assert got[kept] == (0, 0, 0, 0, 0, 0, "K", sha256(b":x.").hexdigest())
    none = table.limit(0)
    assert conversations.repair(conversations.damaged(none, "conv_id", "turn", "role", "text"), none.selectExpr("conv_id as conv")).count() == 0
