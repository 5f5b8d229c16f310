"""Against brute force over all pairs of sets."""

import random
import re

import pyarrow as pa
import pytest

from ledgerline.llm import neardup, text_queries  # noqa: F401
from ledgerline.llm.components import components
from ledgerline.llm.registry import QUERIES


def brute(rows, k, percent=80):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} or ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    keys = sorted(sets)
    for at, a in enumerate(keys):
        for b in keys[:at]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_query_on_the_small_tables(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert result(QUERIES["op7_near_duplicates"](spark, small)) == brute(rows, 2)


def test_families_chains_and_odd_rows(spark):
    pick = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for _ in range(6):
        base = [pick.choice(words) for _ in range(60)]
        for _ in range(12):
            text = list(base)
            for _ in range(pick.randrange(4)):
                text[pick.randrange(60)] = pick.choice(words)
            rows.append((n, " ".join(text)))
            n += 1
        for _ in range(5):  # a drifting chain
            base = list(base)
            base[pick.randrange(60)] = pick.choice(words)
            rows.append((n, " ".join(base)))
            n += 1
    rows += [(900, ""), (901, None), (902, "One"), (903, "oNE"), (904, "one two"), (905, " \t\n"), (906, "é É")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(neardup.near_duplicates(docs, k=2)) == brute(rows, 2)
    assert result(neardup.near_duplicates(docs, k=5)) == brute(rows, 5)


def test_blocks_find_what_stars_miss(spark, monkeypatch):
    """Links between members of a bucket whose hub is no neighbour of theirs."""
    pick = random.Random(3)
    shared = [f"s{i}" for i in range(80)]
    rows = []
    for i in range(40):
        own = [f"o{i // 2}x{j}" for j in range(60)]
        if i % 2:
            own[pick.randrange(60)] = "changed"
        rows.append((i, " ".join(shared + own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(neardup, "BLOCK", 4)
    assert result(neardup.near_duplicates(docs, k=2)) == brute(rows, 2)


def test_repeats_null_ids_and_nothing(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as n", "3 as component")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in neardup.near_duplicates(docs).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7), (200, 201), (201, 202), (202, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90, 200: 200, 201: 200, 202: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_thresholds_grow_with_the_sample(percent):
    least = neardup.least_matches(percent, 1e-5)
    assert least[0] == 0 and least == sorted(least) and least[-1] < neardup.HASHES * percent / 100


def test_blocks_of_over_two_gigabytes():
    """Two texts of 1.1 GiB in one block: pyarrow keeps such a column in two chunks if its offsets are short."""
    text = "x" * (1100 << 20)
    batches = (pa.RecordBatch.from_arrays([pa.array([1]), pa.array([i]), pa.array([text])], ["part", "id", "text"]) for i in (7, 8))
    seen = list(neardup._by_block(("part",), lambda part: part.column("id").to_pylist())(batches))
    assert seen == [[7, 8]]
