"""The given tables seen as a ledger: DataFrames, and the same views as SQL text.

Only columns are renamed and derived here, row by row; every row of a table stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import codec
from ledgerline.functions.text import segment_of
from ledgerline.operators.ordered import bucket_of, large_keys, running_totals
from ledgerline.session import use_utc

DELTA = 36
PER_SEGMENT = 500
ACTIONS_PER_BLOCK = 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def sha(*parts) -> Column:
    return F.sha2(F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]).cast("binary"), 256)


def text(name: str) -> Column:
    return F.col(name).cast("string")


def broken_link() -> Column:
    return (
        (F.col("o_orderstatus") == "P")
        & (F.col("o_orderpriority") == "1-URGENT")
        & (F.month("o_orderdate") == 1)
    )


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    number = key + DELTA
    parent = F.when(broken_link(), sha("x", text("o_orderkey"))).otherwise(
        sha((key - 1).cast("string"))
    )
    return orders.select(
        number.alias("block_num"),
        key.alias("evm_block_num"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        sha("n", text("o_orderkey")).alias("native_hash"),
        sha(text("o_orderkey")).alias("evm_hash"),
        parent.alias("evm_prev_hash"),
        sha("r", text("o_orderkey")).alias("receipts_root"),
        sha("t", text("o_orderkey")).alias("transactions_root"),
        F.col("o_custkey").alias("size"),
        segment_of(number, PER_SEGMENT).alias("segment"),
        "o_orderstatus",
        "o_orderpriority",
    )


V_BLOCKS = f"""v_blocks AS (
  SELECT o_orderkey + {DELTA} AS block_num, o_orderkey AS evm_block_num, o_orderdate AS ts,
         sha256('n' || o_orderkey) AS native_hash, sha256(CAST(o_orderkey AS VARCHAR)) AS evm_hash,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AND month(o_orderdate) = 1
              THEN sha256('x' || o_orderkey)
              ELSE sha256(CAST(o_orderkey - 1 AS VARCHAR)) END AS evm_prev_hash,
         sha256('r' || o_orderkey) AS receipts_root, sha256('t' || o_orderkey) AS transactions_root,
         o_custkey AS size, (o_orderkey + {DELTA}) // {PER_SEGMENT} AS segment,
         o_orderstatus, o_orderpriority
  FROM orders)"""


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions without their index."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("block"),
        (F.col("l_orderkey") + DELTA).alias("block_num"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_linenumber").cast("bigint").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        (F.col("l_extendedprice") * 100).cast("decimal(20,0)").cast("bigint").alias("price"),
        (F.col("l_quantity") * 1000).cast("bigint").alias("gasused"),
        sha(text("l_orderkey"), "-", text("l_linenumber")).alias("hash"),
        segment_of(F.col("l_orderkey") + DELTA, PER_SEGMENT).alias("segment"),
    )


TX_ORDER = ["ts", "line", "part", "supp", "price"]

V_TX = f"""v_tx AS (
  SELECT *, row_number() OVER (PARTITION BY block ORDER BY ts, line, part, supp, price) - 1 AS trx_index
  FROM (SELECT l_orderkey AS block, l_orderkey + {DELTA} AS block_num, l_shipdate AS ts,
               CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part, l_suppkey AS supp,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS price,
               CAST(l_quantity * 1000 AS BIGINT) AS gasused,
               sha256(l_orderkey || '-' || l_linenumber) AS hash,
               (l_orderkey + {DELTA}) // {PER_SEGMENT} AS segment
        FROM lineitem))"""


def ship_day() -> Column:
    """Rises with the transaction order and spreads a block over many days."""
    return F.unix_date(F.col("ts").cast("date")).cast("bigint")


def ship_term() -> Column:
    """Of 128 days: most blocks lie in one or two. Only for measures that are never NULL, since a sum is NULL where its
    bucket has held only NULLs so far."""
    return bucket_of(ship_day(), 128)


def indexed(spark: SparkSession, folder: str, **measures: Column) -> DataFrame:
    """Transactions with their index, and running totals in the same pass. With measures, only large blocks, and the rows
    without one, are cut by days; a total is NULL where its day has held only NULLs so far."""
    txs, spread, several, stretch = transactions(spark, folder), ship_term(), None, None
    if measures:
        large = large_keys(txs, "block").withColumn("_large", F.lit(True))
        txs, stretch = txs.join(F.broadcast(large), "block", "left"), ship_day()
        spread, several = F.when(F.col("_large") | F.col("block").isNull(), stretch), txs.where("_large")
    counted = {"trx_index": F.lit(1).cast("bigint"), **measures}
    ranked = running_totals(txs, "block", TX_ORDER, spread, counted, ["hash"], several, stretch)
    return ranked.withColumn("trx_index", F.col("trx_index") - 1).drop("_large")


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Block arrivals with a reorganisation every 50 and a deeper one every 300."""
    seq = F.col("event_id")
    step = lambda every: F.call_function("div", seq, F.lit(every).cast("bigint"))
    return table(spark, folder, "events").select(
        seq.alias("arrival_seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        (seq - 3 * step(50) - 5 * step(300)).alias("n"),
        (seq + 2 * step(97)).alias("jumping_n"),
    )


V_ARRIVALS = """v_arrivals AS (
  SELECT event_id AS arrival_seq, ts, event_id - 3 * (event_id // 50) - 5 * (event_id // 300) AS n,
         event_id + 2 * (event_id // 97) AS jumping_n
  FROM events)"""

V_FORKS = """v_forks AS (
  SELECT arrival_seq, ts, n - 1 AS last_non_forked, prev_n AS last_forked
  FROM (SELECT *, lag(n) OVER (ORDER BY arrival_seq) AS prev_n FROM v_arrivals) WHERE n <= prev_n)"""


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Registered customers; those of one nation are registered twice."""
    customer = table(spark, folder, "customer")
    address = F.substring(sha("a", text("c_custkey")), 1, 40)
    other = F.substring(sha("b", text("c_custkey")), 1, 40)
    addresses = F.when(F.col("c_nationkey") == 3, F.array(address, other)).otherwise(F.array(address))
    # customers of one segment are registered under another name, so nobody finds them
    name = F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("old"), "c_name")).otherwise(F.col("c_name"))
    return customer.select(name.alias("account"), F.explode(addresses).alias("address"))


V_ACCOUNTS = """v_accounts AS (
  SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'old' || c_name ELSE c_name END AS account,
         substr(sha256(which || c_custkey), 1, 40) AS address
  FROM customer JOIN (VALUES ('a'), ('b')) AS t(which) ON which = 'a' OR c_nationkey = 3),
v_address AS (SELECT account, min(address) AS address FROM v_accounts GROUP BY account HAVING count(*) = 1)"""

MEMO_SQL = """CASE WHEN value < 20 THEN ''
     WHEN value < 50 THEN '0x' || upper(substr(sha256('m' || user_id), 1, 40))
     WHEN value < 80 THEN '0xnothex' ELSE 'hello' END"""


def _memo() -> Column:
    value = F.col("value")
    return (
        F.when(value < 20, F.lit(""))
        .when(value < 50, F.concat(F.lit("0x"), F.upper(F.substring(sha("m", text("user_id")), 1, 40))))
        .when(value < 80, F.lit("0xnothex"))
        .otherwise(F.lit("hello"))
    )


def _receipt() -> Column:
    """Console text of a raw action: noise, the receipt between its marks, noise."""
    return F.concat(
        F.lit('hello RCPT{{{"status":1,"epoch":'),
        text("event_id"),
        F.lit(',"itxs":[{"callType":"0","from":"aa","input":"beef","to":"bb","traceAddress":[0,1]}],"logs":'),
        F.when(
            F.col("value") < 50,
            F.concat(
                F.lit('[{"address":"'),
                F.substring(sha("c", text("user_id")), 1, 39),
                F.lit('","topics":["'),
                F.substring(sha("k", F.col("props")), 1, 60),
                F.lit('"],"data":"00"}]'),
            ),
        ).otherwise(F.lit("[]")),
        F.lit(',"errors":[],"output":"","gasused":"'),
        F.lower(F.hex(F.lit(21000) + F.col("event_id"))),
        F.lit('","gasusedblock":"","charged_gas":"'),
        F.lower(F.hex(F.col("user_id") + 1)),
        F.lit('","createdaddr":"ABCD'),
        F.lpad(text("user_id"), 36, "0"),
        F.when(F.col("value") > 140, F.lit("} broken }}RCPT")).otherwise(F.lit('"}}}RCPT trailing')),
    )


def actions(spark: SparkSession, folder: str, with_raw: bool = True) -> DataFrame:
    """Native actions of all kinds; some digests repeat inside a block."""
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    block = F.call_function("div", F.col("event_id"), F.lit(ACTIONS_PER_BLOCK).cast("bigint"))
    account = F.concat(F.lit("Customer#"), F.lpad(text("user_id"), 9, "0"))
    quantity = F.format_string("%.4f SYS", F.col("value"))
    is_transfer = kind.isin("purchase", "view")
    sender = F.when(
        F.col("value") < 120, F.substring(sha("s", text("user_id")), 1, 40)
    ).otherwise(F.lit("nobody"))
    if with_raw:
        tx = F.when(
            kind == "signup",
            codec.encode_legacy(
                F.when(kind == "signup", F.col("event_id")).otherwise(F.lit(0)),
                F.lit(500) + F.col("user_id"),
                F.lit(1_000_000),
                F.concat(F.lit("0x"), F.substring(sha("to", text("user_id")), 1, 40)),
                F.lower(F.hex((F.col("value") * 100).cast("decimal(20,0)").cast("bigint"))),
                F.concat(F.lit("0x"), sha("d", F.col("props"))),
            ),
        )
        console = F.when(kind == "signup", _receipt()).otherwise(F.lit(""))
    else:
        tx, console = F.lit(None).cast("string"), F.lit("")
    return events.select(
        block.alias("arrival_seq"),
        (block + DELTA).alias("block_num"),
        sha("b", block.cast("string")).alias("block_id"),
        F.col("ts").cast("timestamp").alias("block_ts"),
        (F.col("event_id") % ACTIONS_PER_BLOCK).alias("action_seq"),
        F.when(is_transfer, "eosio.token")
        .when(kind.isin("click", "signup"), "eosio.evm")
        .otherwise("eosio.msig")
        .alias("account"),
        F.when(is_transfer, "transfer")
        .when(kind == "click", "withdraw")
        .when(kind == "signup", "raw")
        .otherwise("exec")
        .alias("name"),
        F.when(kind == "view", account).otherwise("eosio.evm").alias("receiver"),
        sha(block.cast("string"), "-", kind, "-", F.col("props")).alias("act_digest"),
        sha("t", text("event_id")).alias("trx_id"),
        (F.col("event_id") % ACTIONS_PER_BLOCK + 1).alias("action_ordinal"),
        console.alias("console"),
        F.struct(
            F.when(is_transfer, account).alias("from"),
            F.when(is_transfer, F.lit("eosio.evm")).when(kind == "click", account).alias("to"),
            F.when(kind != "signup", quantity).alias("quantity"),
            F.when(is_transfer, _memo()).alias("memo"),
            tx.alias("tx"),
            F.when(kind == "signup", sender).alias("sender"),
        ).alias("data"),
        "user_id",
        "value",
        "props",
    )


V_ACTIONS = f"""v_actions AS (
  SELECT event_id, event_id % {ACTIONS_PER_BLOCK} AS action_seq, event_id // {ACTIONS_PER_BLOCK} + {DELTA} AS block_num,
         event_id // {ACTIONS_PER_BLOCK} AS block, sha256('b' || (event_id // {ACTIONS_PER_BLOCK})) AS block_id,
         event_id % {ACTIONS_PER_BLOCK} + 1 AS action_ordinal, user_id, value, props, ts, event_type,
         'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS account_name,
         printf('%.4f SYS', value) AS quantity,
         {MEMO_SQL} AS memo,
         CAST(round(value * 10000) AS BIGINT) AS units,
         sha256((event_id // {ACTIONS_PER_BLOCK}) || '-' || event_type || '-' || props) AS act_digest,
         CASE event_type WHEN 'purchase' THEN 'deposit' WHEN 'click' THEN 'withdraw'
              WHEN 'signup' THEN 'raw' END AS kind
  FROM events),
v_accepted AS (
  SELECT *, row_number() OVER (PARTITION BY block_num ORDER BY action_seq) - 1 AS trx_index
  FROM (SELECT *, row_number() OVER (PARTITION BY block_num, act_digest ORDER BY action_seq) AS copy
        FROM v_actions WHERE kind IS NOT NULL) WHERE copy = 1)"""
