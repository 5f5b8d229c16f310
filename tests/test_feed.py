"""Messages that are sent once, and read as a table or as a stream."""

import glob
import json
import os

from ledgerline.sources.feed import Outbox, Sent, read_feed, send, send_stream

MESSAGES = "type string, block bigint, trx_index bigint, message string"


def messages(spark, numbers):
    return spark.createDataFrame([("raw", n, 0, f"message {n}") for n in numbers], MESSAGES)


def in_order(df):
    return [r.block for r in df.orderBy("batch", "part", "row").collect()]


def test_a_batch_is_sent_once_and_in_order(spark, folder):
    feed = messages(spark, range(100)).repartition(7).orderBy("block")
    send(feed, folder, 4)
    send(messages(spark, range(100, 120)), folder, 11)
    assert in_order(read_feed(spark, folder)) == list(range(120))
    files = sorted(os.listdir(f"{folder}/parts"))
    send(messages(spark, range(500)), folder, 4)  # a replay
    assert in_order(read_feed(spark, folder)) == list(range(120))
    assert sorted(os.listdir(f"{folder}/parts")) == files  # leaves nothing behind


def test_nothing_is_seen_before_it_is_committed(spark, folder):
    outbox = Outbox(folder)
    send(messages(spark, [1]), folder, 0)
    lost = f"{folder}/parts/lost.parquet"
    os.link(glob.glob(f"{folder}/parts/*.parquet")[0], lost)
    assert in_order(read_feed(spark, folder)) == [1]
    outbox.discard([Sent(0, "lost.parquet", 1), Sent(1, None, 0), None])  # a batch given up, one task of it without rows
    assert not os.path.exists(lost) and outbox.committed() == [0]


def test_no_messages(spark, folder):
    assert read_feed(spark, folder).count() == 0
    send(messages(spark, []), folder, 0)
    assert read_feed(spark, folder).count() == 0
    assert Outbox(folder).committed() == [0]


def test_streams_in_and_out(spark, folder):
    source, sent, out = f"{folder}/in", f"{folder}/feed", f"{folder}/out"

    def advance(numbers):
        messages(spark, numbers).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1).parquet(source)
        send_stream(stream, sent, f"{folder}/checkpoint-in").awaitTermination()
        followed = read_feed(spark, sent, stream=True).writeStream.format("parquet").option("path", out)
        followed.option("checkpointLocation", f"{folder}/checkpoint-out").trigger(availableNow=True).start().awaitTermination()
        return sorted(r.block for r in spark.read.parquet(out).collect())

    assert advance([1, 2, 3]) == [1, 2, 3]
    assert advance([4]) == [1, 2, 3, 4]
    # The engine forgets that the last batch was committed, and sends it again.
    last = max(Outbox(sent).committed())
    for name in (str(last), f".{last}.crc"):
        os.remove(f"{folder}/checkpoint-in/commits/{name}")
    assert advance([5]) == [1, 2, 3, 4, 5]
    assert [json.load(open(f"{sent}/batches/{b}.json"))["rows"] for b in Outbox(sent).committed()] == [3, 1, 1]


def test_heads_meet_their_gas_with_hashes_as_bytes(spark):
    """Hashes went through the shuffle as text, twice as long."""
    from pyspark.sql import functions as F

    from ledgerline.operators import feed

    names = ("native_hash", "evm_hash", "evm_prev_hash", "receipts_root", "transactions_root", "logs_bloom")
    texts = ["ab", "AB", "0xab", "", "abc", "00"]
    blocks = spark.createDataFrame([(1, *texts), (2, *texts[::-1])], "evm_block_num bigint, " + ", ".join(f"{n} string" for n in names))
    blocks = blocks.withColumn("ts", F.lit(0).cast("timestamp")).withColumn("gas_used", F.lit(7))
    txs = spark.createDataFrame([(1, 0, 3), (1, 1, 7), (2, 0, 7)], "block bigint, trx_index bigint, gasusedblock bigint")
    joined = feed.head_messages(blocks, txs)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, feed.head_messages(blocks).collect()))
    assert "unhex" in joined._jdf.queryExecution().optimizedPlan().toString()


def test_transactions_are_ranked_once(spark, small):
    """Messages and heads each ranked all transactions anew."""
    from ledgerline.plans import chain_queries

    made = chain_queries.head_feed(spark, small)
    assert "lineitem" not in made._jdf.queryExecution().executedPlan().toString()
    tables = [spark.read.parquet(f"{small}/{name}.parquet").count() for name in ("lineitem", "orders")]
    assert made.count() == sum(tables)


def test_gas_of_nothing_but_nulls_stays_null(spark, folder):
    """As ever, a running gas is NULL where its day has held only NULLs so far."""
    from ledgerline.plans import views

    names = "l_orderkey bigint, l_shipdate timestamp, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_quantity double"
    rows = [(1, f"2020-01-0{d}", n, 1, 1, 1.0, q) for d, n, q in ((1, 1, 2.0), (2, 2, None), (2, 3, 3.0))]
    text = spark.createDataFrame(rows, names.replace("timestamp", "string"))
    text.withColumn("l_shipdate", text.l_shipdate.cast("timestamp")).write.parquet(f"{folder}/lineitem.parquet")
    made = views.indexed(spark, folder, total=views.F.col("gasused")).orderBy("trx_index").collect()
    assert [(r.trx_index, r.total) for r in made] == [(0, 2000), (1, None), (2, 5000)]


def lineitem(spark, folder, rows):
    """Rows of block, day of January or None, line, quantity."""
    names = "l_orderkey bigint, l_shipdate string, l_linenumber int, l_quantity double, l_partkey bigint, l_suppkey bigint, l_extendedprice double"
    text = spark.createDataFrame([(b, d and f"2020-01-{d:02}", n, q, 1, 1, 1.0) for b, d, n, q in rows], names)
    text.withColumn("l_shipdate", text.l_shipdate.cast("timestamp")).write.parquet(f"{folder}/lineitem.parquet")


def shuffled(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_what_was_shuffled_for_the_ranking_is_gone_before_the_feed_is_read(spark, small):
    """It stayed on disk beside the ranked transactions until the driver collected its garbage."""
    import time

    from ledgerline import session
    from ledgerline.plans import chain_queries

    before = shuffled(spark)
    made = chain_queries.head_feed(spark, small)
    until = time.time() + 20
    while (left := shuffled(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(session.SHUFFLES_GO, "false") == "false"
    assert made.where("type = 'raw'").count() == spark.read.parquet(f"{small}/lineitem.parquet").count()


def test_only_large_blocks_are_cut_by_days(spark, folder, monkeypatch):
    """Every block was cut by days, and each of its days was shuffled three times more. The totals are the same."""
    import random

    from ledgerline.operators import ordered
    from ledgerline.plans import views

    random.seed(5)
    odd = [(None, 1, 1, 2.0), (None, 1, 2, 3.0), (None, 2, 1, None), (9, None, 1, None), (9, None, 2, 4.0), (9, 3, 3, None)]
    lines = [(b, random.choice([None, *range(1, 6)]), n, random.choice([None, 1.0, 2.0])) for b in range(6) for n in range(3 * b)]
    lineitem(spark, folder, odd + lines)
    found = {}
    for width in (0, 5, 10**6):  # all blocks are large, some, none
        monkeypatch.setattr(views, "large_keys", lambda df, by, width=width: ordered.large_keys(df, by, width))
        made = views.indexed(spark, folder, total=views.F.col("gasused")).select("block", "ts", "line", "trx_index", "total")
        found[width] = sorted(map(repr, made.collect()))
    assert found[0] == found[5] == found[10**6] and len(found[0]) == len(odd + lines)

    sums, order = {}, lambda r: (r.ts is not None, str(r.ts), r.line)
    for r in sorted((r for r in made.collect() if r.block is not None), key=order):
        (index, total, day, held) = sums.get(r.block, (0, 0, "none yet", False))
        gas = next(q for b, d, n, q in odd + lines if (b, n) == (r.block, r.line))
        held = gas is not None or (held and day == r.ts)
        total += int(1000 * (gas or 0))
        assert (r.trx_index, r.total) == (index, total if held else None)
        sums[r.block] = (index + 1, total, r.ts, held)


def test_heads_of_any_number_find_their_gas(spark):
    """Blocks are joined by cells of 64: at their edges, below 0, twice, without a number or without transactions."""
    from pyspark.sql import functions as F

    from ledgerline.operators import feed

    names = ("native_hash", "evm_hash", "evm_prev_hash", "receipts_root", "transactions_root", "logs_bloom")
    numbers = [-65, -64, -1, 0, 63, 64, 64, 65, 127, 128, 2**40, None]
    blocks = spark.createDataFrame([(n,) for n in numbers], "evm_block_num bigint")
    blocks = blocks.withColumns({n: F.lit("ab") for n in names} | {"ts": F.lit(0).cast("timestamp")})
    txs = [(n, i, 1000 + n % 1000 + i) for n in sorted({*numbers[:-1], 62, 129} - {65}) for i in (1, 0, 2)] + [(None, 0, 5)]
    txs_df = spark.createDataFrame(txs, "block bigint, trx_index bigint, gasusedblock bigint")
    gas = {b: g for b, i, g in txs if i == 2}
    want = [(n, hex(gas.get(n, 0))) for n in numbers]
    for slices in (1, 3):
        heads = feed.head_messages(blocks, txs_df, slices).collect()
        got = [(r.block, json.loads(r.message)["data"]["gasUsed"]) for r in heads]
        assert sorted(got, key=str) == sorted(want, key=str)
