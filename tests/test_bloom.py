"""Union of blooms against the bits themselves, and the shape of its plan."""

from pyspark.sql import functions as F

from ledgerline.operators.bloom import bloom_or
from ledgerline.operators.totals import tx_totals


def test_union_of_any_blooms(spark):
    high, low = "f" + "0" * 511, "0" * 511 + "1"
    rows = [(1, high), (1, low), (1, None), (2, "FF"), (2, "0" * 16 + "8" + "0" * 495 + "ff"), (3, "xyz"), (4, None), (4, ""), (5, "1" * 512), (5, "E" * 512)]
    rows += [(6, "0f"), (6, "f"), (None, low)]
    df = spark.createDataFrame(rows, "block bigint, logs_bloom string").withColumn("gasused", F.lit(1))
    want = {1: "f" + "0" * 510 + "1", 2: "ff" + "0" * 14 + "8" + "0" * 495, 3: "0" * 512, 5: "f" * 512, 6: "0f" + "0" * 510, None: low}
    assert {r.block: r.logs_bloom for r in bloom_or(df, "block").collect()} == want
    totals = {r.block: (r.logs_bloom, r.tx_count) for r in tx_totals(df, bloom=True).collect()}
    assert totals == {**{k: (v, [r[0] for r in rows].count(k)) for k, v in want.items()}, 4: ("0" * 512, 2)}


def test_union_is_hashed_not_sorted(spark):
    """The engine's bitmap aggregate sorted rows with buffers of 4 KB, which spilled."""
    df = spark.createDataFrame([(1, "00")], "block bigint, logs_bloom string")
    plan = bloom_or(df, "block")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan
