"""Against a manifest built in plain lists."""

from hashlib import sha256
from zlib import crc32

from pyspark.sql import functions as F

from ledgerline.llm import merkle, shape_queries
from ledgerline.llm.registry import QUERIES


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, at):
    out = []
    for nodes in levels[:-1]:
        begin = at - at % 3
        run = nodes[begin : begin + 3]
        out.append((at - begin, [x for i, x in enumerate(run) if i != at - begin]))
        at //= 3
    return out


def brute(rows, tamper):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {s: tree([leaf_of(r) for r in groups[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for place, source in enumerate(sources):
        for at, row in enumerate(groups[source]):
            steps = path(trees[source], at) + path(top, place)
            folded = leaf_of(tamper(row))
            for own, others in steps:
                folded = h(*others[:own], folded, *others[own:])
            proof = h(*[x for _, others in steps for x in others])
            out.append((row[0], leaf_of(row), trees[source][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def bare(row):
    if row[0] is None or row[4] is None or crc32(str(row[0]).encode()) % 2:
        return row
    return (*row[:4], row[4].replace("\n", ""))


def test_query_on_the_small_tables(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*shape_queries.FIELDS).collect()]
        got = sorted(map(tuple, QUERIES["op11_merkle_manifest"](spark, folder).collect()), key=repr)
        assert got == brute(rows, bare)
        assert 0 < sum(r[-1] for r in got) < len(got)


def test_trees_of_many_superblocks_null_fields_and_repeats(spark):
    rows = [(i, f"s{i % 3}", "x", 2, f"text {i}") for i in range(200)]
    rows += [(i, f"one{i}", None, None, "é") for i in range(300, 340)]
    rows += [(5, None, None, None, None), (5, None, None, None, None), (None, None, "", 0, ""), (None, "s1", "x", 1, "z" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.selectExpr("*", "1 as pos", "2 as n", "3 as h", "4 as tree")
    leaf = merkle.leaf_digest(*[F.col(c) for c in shape_queries.FIELDS])
    want = brute(rows, lambda row: row)
    for shape in (merkle.Shape(3, 1), merkle.Shape(3, 2), merkle.Shape()):
        got = sorted(map(tuple, merkle.manifest(docs, "doc_id", "source", leaf, leaf, shape).collect()), key=repr)
        assert got == want
        assert all(r[-1] for r in got)


def test_one_row_and_nothing(spark):
    docs = spark.createDataFrame([(1, "a", "b", 2, "c")], "doc_id long, source string, lang string, n_chars long, text string")
    leaf = merkle.leaf_digest(*[F.col(c) for c in shape_queries.FIELDS])
    (only,) = merkle.manifest(docs, "doc_id", "source", leaf, leaf).collect()
    assert only.leaf == only.subroot == only.root == only.folded_root and only.verified and only.proof_sha256 == h("")
    assert merkle.manifest(docs.limit(0), "doc_id", "source", leaf, leaf).count() == 0
