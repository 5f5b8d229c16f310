"""The stages against brute-force versions, each on its predecessor's result."""

import base64

import corpus_pipeline as pipeline
import public_tokenizers
import tiktoken
from ledgerline.llm import catalogue, langid

from llm.test_decontaminate import brute as brute_hits
from llm.test_neardup import brute as brute_groups
from llm.test_secrets import brute as brute_secrets


def test_registration():
    import __spark_entry__

    assert [name for name, _ in pipeline.STAGES] == ["languages", "near_duplicates", "benchmark", "secrets", "bpe"]
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert set(catalogue.SQL) <= set(catalogue.QUERIES)


def test_stages(spark, small, folder):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    junk = spark.createDataFrame([(10**6, None, "en", "x", 0), (10**6 + 1, "12 !!", None, None, None)], docs.schema)
    docs, columns = docs.unionByName(junk), docs.columns
    kept = []
    for at, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, small)
        out.write.parquet(f"{folder}/{at}")
        docs = spark.read.parquet(f"{folder}/{at}")
        assert at == 4 or docs.columns == columns
        kept.append({r.doc_id: r for r in docs.collect()})
    languages, groups, clean, blotted, ids = kept
    assert 10**6 not in languages and 10**6 + 1 not in languages and len(languages) >= 0.95 * (spark.read.parquet(f"{small}/documents.parquet").count())
    want = brute_groups([(i, r.text) for i, r in languages.items()], 5)
    assert set(groups) == {i for i, (_, _, first) in want.items() if first}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    found = brute_hits([(i, r.text) for i, r in groups.items()], items)
    assert set(clean) == {i for i, n, hit, _ in found if not (hit and 20 * hit >= n)}
    assert set(blotted) == set(clean)
    for i, r in blotted.items():
        assert not brute_secrets(r.text) and (brute_secrets(clean[i].text) != []) <= ("[SECRET]" in r.text)
        assert r.text == clean[i].text or r.n_chars == len(r.text)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {i: r.ids for i, r in ids.items()} == {i: library.encode_ordinary(r.text) for i, r in blotted.items()}


def test_nothing_in_nothing_out(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.count() == 0
    assert langid.UNKNOWN == "und"
