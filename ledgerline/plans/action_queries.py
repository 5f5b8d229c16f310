"""Queries over native actions, scalar functions, validation and translation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import codec
from ledgerline.functions import hexes as H
from ledgerline.functions import text as X
from ledgerline.operators import actions as A
from ledgerline.operators import translate as T
from ledgerline.operators import validate
from ledgerline.operators.bloom import bloom_build
from ledgerline.plans import views as V
from ledgerline.plans.keccak_sql import BITS, bloom_sql, digest_views
from ledgerline.plans.registry import query
from ledgerline.sources import documents
from ledgerline.sources.actions import irreversible

# --- scalar functions -----------------------------------------------------------


@query(
    "asset_parse",
    """SELECT event_id, replace(printf('%.2f', value), '.', '') AS amount, 2::BIGINT AS "precision", event_type AS symbol
       FROM events""",
)
def asset_parse(spark, folder):
    asset = X.parse_asset(F.concat(F.format_string(" %.2f  ", F.col("value")), F.col("event_type"), F.lit(" ")))
    rows = V.table(spark, folder, "events").withColumn("a", asset)
    return rows.select("event_id", "a.amount", F.col("a.precision").cast("bigint").alias("precision"), "a.symbol")


@query(
    "amount_to_wei",
    """SELECT event_id, CAST(round(value * 10000) AS BIGINT) || CASE WHEN value = 0 THEN '' ELSE repeat('0', 14) END AS wei,
              CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS whole FROM events""",
)
def amount_to_wei(spark, folder):
    amount = X.parse_asset(F.format_string("%.4f SYS", F.col("value")))["amount"]
    wei = X.asset_to_wei(amount)
    rows = V.table(spark, folder, "events").withColumn("w", wei)
    return rows.select("event_id", F.col("w").cast("string").alias("wei"), X.wei_to_whole(F.col("w")).alias("whole"))


@query(
    "name_to_uint64",
    """SELECT c_custkey, CAST(sum(CASE WHEN i < 12 THEN (p % 32) * CAST(pow(2, CAST(59 - 5 * i AS INTEGER)) AS HUGEINT)
                                       ELSE p % 16 END) AS VARCHAR) AS number
       FROM (SELECT c_custkey, i, greatest(instr('.12345abcdefghijklmnopqrstuvwxyz',
                    CASE WHEN i < length(c_name) THEN substr(lower(c_name), i + 1, 1) ELSE '.' END) - 1, 0) AS p
             FROM customer, (SELECT unnest(range(13)) AS i)) GROUP BY c_custkey""",
)
def name_to_uint64(spark, folder):
    number = X.name_to_uint64(F.lower("c_name"))
    return V.table(spark, folder, "customer").select("c_custkey", number.cast("string").alias("number"))


@query(
    "hex_codec",
    """SELECT o_orderkey, '0x' || lower(to_hex(o_custkey)) AS as_hex, o_custkey AS back,
              lpad(lower(to_hex(o_custkey)), 40, '0') AS padded, '0x' || ltrim(lower(to_hex(o_custkey)), '0') AS unpadded,
              sha256(CAST(o_orderkey AS VARCHAR)) AS bytes_back, substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 10) AS trimmed,
              CAST(epoch(o_orderdate) AS BIGINT) AS epoch, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso
       FROM orders""",
)
def hex_codec(spark, folder):
    as_hex = H.num_to_hex(F.col("o_custkey"))
    padded = H.pad_hex(H.strip_0x(as_hex), 40)
    digest = V.sha(F.col("o_orderkey").cast("string"))
    ts = F.col("o_orderdate").cast("timestamp")
    return V.table(spark, folder, "orders").select(
        "o_orderkey",
        as_hex.alias("as_hex"),
        H.hex_to_decimal(as_hex).cast("bigint").alias("back"),
        padded.alias("padded"),
        H.unpad_hex(padded).alias("unpadded"),
        H.to_hex(H.from_hex(H.add_0x(digest))).alias("bytes_back"),
        H.trim_input(digest, 10).alias("trimmed"),
        X.epoch_seconds(ts).alias("epoch"),
        X.iso_second(ts).alias("iso"),
    )


# The last 15 digits are 60 bits, so the sum of them and an index fits a BIGINT.
R_SQL = """'0x' || ltrim(CASE WHEN low >= 1152921504606846976 THEN 'carry' ELSE substr(h, 1, 49)
  || lpad(lower(to_hex(low)), 15, '0') END, '0')"""


@query(
    "synthetic_vrs",
    f"""SELECT block, trx_index, '42' AS v, {R_SQL} AS r,
               '0x' || ltrim(rpad(lpad(lower(to_hex(part)), 40, '0'), 64, '0'), '0') AS s
        FROM (SELECT *, CAST('0x' || substr(h, 50, 15) AS BIGINT) + trx_index AS low
              FROM (SELECT *, sha256(CAST(block AS VARCHAR)) AS h FROM v_tx))""",
    (V.V_TX,),
)
def synthetic_vrs(spark, folder):
    sender = H.add_0x(H.pad_hex(H.strip_0x(H.long_to_hex(F.col("part"))), 40))
    vrs = H.synthetic_vrs(V.sha(F.col("block").cast("string")), sender, F.col("trx_index"))
    return V.indexed(spark, folder).withColumn("x", vrs).select("block", "trx_index", "x.*")


@query(
    "validators",
    """SELECT l_orderkey AS block, l_partkey AS part, l_suppkey AS supp, l_linenumber = 1 AS integer_ok,
              length(h) > 0 AND regexp_full_match(h, '[0-9a-fA-F]*') AS bare_hex_ok,
              regexp_full_match(h, '[0-9a-fA-F]{40}') AS address_ok, l_linenumber <> 3 AS hash_ok,
              l_returnflag <> 'A' AS asset_ok, l_returnflag = 'R' AS date_ok
       FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN substr(sha256(CAST(l_partkey AS VARCHAR)), 1, 40)
                       WHEN 'N' THEN '' ELSE 'xyz' END AS h FROM lineitem)""",
)
def validators(spark, folder):
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    digest = V.sha(F.col("l_partkey").cast("string"))
    h = F.when(flag == "A", F.substring(digest, 1, 40)).when(flag == "N", "").otherwise("xyz")
    number = F.when(line == 1, F.col("l_suppkey").cast("string")).otherwise(
        F.concat(F.lit("0"), F.col("l_suppkey").cast("string"))
    )
    full = F.concat(F.lit("0x"), F.when(line == 3, F.substring(digest, 2, 63)).otherwise(digest))
    asset = F.when(flag == "A", F.lit("SYS 4.0")).otherwise(F.lit("4.0000 SYS"))
    date = F.when(flag == "R", F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("yesterday-ish")
    return V.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("block"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        X.is_integer(number).alias("integer_ok"),
        X.is_bare_hex(h).alias("bare_hex_ok"),
        X.is_bare_address(h).alias("address_ok"),
        X.is_hash(full).alias("hash_ok"),
        X.is_asset(asset).alias("asset_ok"),
        X.is_timestamp(date).alias("date_ok"),
    )


def _rough_blocks(spark, folder):
    """Blocks as text, with faults that depend on status and priority."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    blocks = V.blocks(spark, folder)
    return blocks.withColumns(
        {
            "evm_hash": F.when(priority == "1-URGENT", F.lit("beef")).otherwise(F.col("evm_hash")),
            "receipts_root": F.when(status == "P", F.lit(None)).otherwise(F.col("receipts_root")),
            "gas_used": F.when(priority == "2-HIGH", F.lit("1e3")).otherwise(F.lit("1000")),
            "gas_limit": F.lit("2147483647"),
        }
    )


@query(
    "validate_blocks",
    """SELECT block_num, concat_ws(',', CASE WHEN u THEN 'evm_hash' END, CASE WHEN p THEN 'receipts_root' END,
                                   CASE WHEN hi THEN 'gas_used' END) AS violations,
              CASE WHEN u THEN 'invalid' WHEN p OR hi THEN 'genesis' ELSE 'block' END AS shape
       FROM (SELECT block_num, o_orderpriority = '1-URGENT' AS u, o_orderstatus = 'P' AS p,
                    o_orderpriority = '2-HIGH' AS hi FROM v_blocks)""",
    (V.V_BLOCKS,),
)
def validate_blocks(spark, folder):
    checked = validate.validate_blocks(_rough_blocks(spark, folder))
    return checked.select("block_num", F.array_join("violations", ",").alias("violations"), "shape")


@query(
    "storable_blocks",
    "SELECT block_num, o_orderpriority <> '1-URGENT' AS storable FROM v_blocks",
    (V.V_BLOCKS,),
)
def storable_blocks(spark, folder):
    return validate.with_storable(_rough_blocks(spark, folder), "block").select("block_num", "storable")


@query(
    "validate_tx",
    """SELECT block, part, supp, price,
              concat_ws(',', CASE WHEN line = 1 THEN 'from' END, CASE WHEN line = 2 THEN 'input_data' END,
                        CASE WHEN line = 3 THEN 'value_d' END, CASE WHEN line = 4 THEN 'nonce' END,
                        CASE WHEN line = 5 THEN 'createdaddr' END, CASE WHEN line = 6 THEN 's' END) AS violations
       FROM v_tx""",
    (V.V_TX,),
)
def validate_tx(spark, folder):
    line = F.col("line")
    bad = lambda at, wrong, good: F.when(line == at, F.lit(wrong)).otherwise(F.lit(good))
    rows = V.transactions(spark, folder).withColumns(
        {
            "trx_id": F.col("hash"),
            "action_ordinal": F.lit(1),
            "hash": F.concat(F.lit("0x"), F.col("hash")),
            "from": bad(1, "0x12", "0x" + "ab" * 20),
            "to": F.lit(None).cast("string"),
            "trx_index": F.lit(0),
            "block_hash": F.lit("ab" * 32),
            "input_data": bad(2, "0xzz", "0xbeef"),
            "input_trimmed": F.lit("0xbeef"),
            "value_hex": F.lit("0"),
            "value_d": bad(3, "4 of them", "4.0000 SYS"),
            "nonce": bad(4, "0x1", "184"),
            "gas_price": F.lit("5"),
            "gas_limit": F.lit("5"),
            "gasusedblock": F.lit("5"),
            "charged_gas_price": F.lit("5"),
            "status": F.lit(1),
            "itxs": F.array(),
            "epoch": F.lit(0),
            "createdaddr": bad(5, "beef", ""),
            "output": F.lit(""),
            "logs_bloom": F.lit(None).cast("string"),
            "v": F.lit("42"),
            "r": F.lit("0x1"),
            "s": bad(6, "g", "0x"),
        }
    )
    checked = validate.validate_tx(rows)
    return checked.select("block", "part", "supp", "price", F.array_join("violations", ",").alias("violations"))


# --- actions --------------------------------------------------------------------


@query("classify_actions", "SELECT action_seq, block_num, kind FROM v_actions WHERE kind IS NOT NULL", (V.V_ACTIONS,))
def classify_actions(spark, folder):
    return A.classify_actions(V.actions(spark, folder, with_raw=False)).select("action_seq", "block_num", "kind")


@query(
    "exclude_senders",
    """SELECT block_num, action_seq, kind FROM v_actions
       WHERE kind IS NOT NULL AND NOT (kind = 'deposit' AND user_id IN (3, 5, 8))""",
    (V.V_ACTIONS,),
)
def exclude_senders(spark, folder):
    names = [f"Customer#{i:09d}" for i in (3, 5, 8)]
    return A.classify_actions(V.actions(spark, folder, with_raw=False), names).select("block_num", "action_seq", "kind")


@query("dedup_actions", "SELECT block_num, action_seq, act_digest FROM v_accepted", (V.V_ACTIONS,))
def dedup_actions(spark, folder):
    kept = A.dedup_actions(A.classify_actions(V.actions(spark, folder, with_raw=False)))
    return kept.select("block_num", "action_seq", "act_digest")


@query("accepted_actions", "SELECT block_num, action_seq, kind, trx_index FROM v_accepted", (V.V_ACTIONS,))
def accepted_actions(spark, folder):
    return T.accepted(V.actions(spark, folder, with_raw=False)).select(
        "block_num", "action_seq", "kind", "trx_index"
    )


@query(
    "irreversible",
    "SELECT action_seq, block_num FROM v_actions WHERE block_num <= user_id",
    (V.V_ACTIONS,),
)
def irreversible_actions(spark, folder):
    return irreversible(V.actions(spark, folder, with_raw=False), "user_id").select("action_seq", "block_num")


@query(
    "address_lookup",
    """SELECT event_id, coalesce(address, '') AS address
       FROM (SELECT event_id, 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS account FROM events)
       LEFT JOIN v_address USING (account)""",
    (V.V_ACCOUNTS,),
)
def address_lookup(spark, folder):
    account = F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))
    events = V.table(spark, folder, "events").select("event_id", account.alias("account"))
    found = A.with_address(events, "account", V.accounts(spark, folder))
    return found.select("event_id", F.coalesce("address", F.lit("")).alias("address"))


@query(
    "ambiguous_accounts",
    "SELECT account, count(*) AS n FROM v_accounts GROUP BY account HAVING count(*) > 1",
    (V.V_ACCOUNTS,),
)
def ambiguous_accounts(spark, folder):
    return A.ambiguous_accounts(V.accounts(spark, folder))


# --- translation ----------------------------------------------------------------

V_RESOLVED = """v_resolved AS (
  SELECT x.*, a.address, memo LIKE '0x%' AND length(memo) = 42 AS memo_ok
  FROM v_accepted x LEFT JOIN v_address a ON a.account = x.account_name)"""

# Amounts have at most 16 digits here, so the product with 10^14 fits HUGEINT.
NATIVE_COLUMNS = f"""block_num, block, trx_index, quantity AS value_d,
  lower(to_hex(CAST(units AS HUGEINT) * 100000000000000)) AS value_hex, '42' AS v, {R_SQL} AS r"""
V_LOW = """v_low AS (SELECT *, block_id AS h, CAST('0x' || substr(block_id, 50, 15) AS BIGINT) + trx_index AS low
  FROM v_resolved)"""


def _native(txs):
    return txs.select("block_num", "block", "trx_index", "value_d", "value_hex", "v", "r", "s", "from", "to", "error")


@query(
    "deposits",
    f"""SELECT {NATIVE_COLUMNS}, '0x' AS s, '0x' || repeat('0', 40) AS "from",
               CASE WHEN memo_ok THEN lower(memo) ELSE '0x' || address END AS "to"
        FROM v_low WHERE kind = 'deposit' AND (memo_ok OR address IS NOT NULL)""".replace("block, trx_index", f"block_num - {V.DELTA} AS block, trx_index", 1),
    (V.V_ACTIONS, V.V_ACCOUNTS, V_RESOLVED, V_LOW),
)
def deposits(spark, folder):
    actions = T.accepted(V.actions(spark, folder, with_raw=False))
    good, _ = T.deposits(actions, V.accounts(spark, folder), V.DELTA)
    return _native(good.withColumn("error", F.lit(""))).drop("error")


@query(
    "withdrawals",
    f"""SELECT {NATIVE_COLUMNS}, '0x' || ltrim(rpad(address, 64, '0'), '0') AS s, '0x' || address AS "from",
               '0x' || repeat('0', 40) AS "to"
        FROM v_low WHERE kind = 'withdraw' AND address IS NOT NULL""".replace("block, trx_index", f"block_num - {V.DELTA} AS block, trx_index", 1),
    (V.V_ACTIONS, V.V_ACCOUNTS, V_RESOLVED, V_LOW),
)
def withdrawals(spark, folder):
    actions = T.accepted(V.actions(spark, folder, with_raw=False))
    good, _ = T.withdrawals(actions, V.accounts(spark, folder), V.DELTA)
    return _native(good.withColumn("error", F.lit(""))).drop("error")


@query(
    "deposit_errors",
    """SELECT block_num, action_seq,
              CASE WHEN memo LIKE '0x%' THEN 'User deposited to an invalid address'
                   ELSE 'User deposited without registering' END AS message
       FROM v_resolved WHERE kind = 'deposit' AND NOT memo_ok AND address IS NULL""",
    (V.V_ACTIONS, V.V_ACCOUNTS, V_RESOLVED),
)
def deposit_errors(spark, folder):
    actions = T.accepted(V.actions(spark, folder, with_raw=False))
    _, bad = T.deposits(actions, V.accounts(spark, folder), V.DELTA)
    return bad.select("block_num", "action_seq", "message")


@query(
    "odd_precision",
    """SELECT block_num, action_seq, 2::BIGINT AS "precision" FROM v_accepted WHERE kind IN ('deposit', 'withdraw') AND value < 20""",
    (V.V_ACTIONS,),
)
def odd_precision(spark, folder):
    actions = T.accepted(V.actions(spark, folder, with_raw=False))
    short = F.when(F.col("value") < 20, F.format_string("%.2f SYS", F.col("value"))).otherwise(
        F.col("data.quantity")
    )
    changed = actions.withColumn("data", F.col("data").withField("quantity", short))
    found = T.odd_precision(changed)
    return found.select("block_num", "action_seq", F.col("precision").cast("bigint").alias("precision"))


RAW_OK = "kind = 'raw' AND value <= 140 AND value < 120"


@query(
    "raw_transactions",
    f"""SELECT block_num, trx_index, '0x' || substr(sha256('s' || user_id), 1, 40) AS "from",
               '0x' || substr(sha256('to' || user_id), 1, 40) AS "to", '0x' || sha256('d' || props) AS input_data,
               lower(to_hex(CAST(round(value * 100) AS BIGINT))) AS value_hex, '0' AS value_d, event_id AS nonce,
               500 + user_id AS gas_price, 1000000::BIGINT AS gas_limit, 21000 + event_id AS gasused,
               user_id + 1 AS charged_gas_price, 1::BIGINT AS status, event_id AS epoch,
               'abcd' || lpad(CAST(user_id AS VARCHAR), 36, '0') AS createdaddr, '42' AS v, {R_SQL} AS r,
               '0x' || ltrim(rpad(substr(sha256('s' || user_id), 1, 40), 64, '0'), '0') AS s,
               CASE WHEN value < 50 THEN 1::BIGINT ELSE 0::BIGINT END AS n_logs, 'beef' AS itx_input
        FROM v_low WHERE {RAW_OK}""",
    (V.V_ACTIONS, V.V_ACCOUNTS, V_RESOLVED, V_LOW),
)
def raw_transactions(spark, folder):
    actions = T.accepted(V.actions(spark, folder))
    good, _ = T.raw_transactions(actions, V.accounts(spark, folder), V.DELTA)
    whole = lambda *names: [F.col(n).cast("bigint").alias(n) for n in names]
    return good.select(
        "block_num",
        "trx_index",
        "from",
        "to",
        "input_data",
        "value_hex",
        "value_d",
        *whole("nonce", "gas_price", "gas_limit", "gasused", "charged_gas_price", "status", "epoch"),
        "createdaddr",
        "v",
        "r",
        "s",
        F.coalesce(F.size("logs"), F.lit(0)).cast("bigint").alias("n_logs"),
        F.col("itxs")[0]["input_trimmed"].alias("itx_input"),
    )


@query(
    "raw_errors",
    f"""SELECT block_num, action_seq, 'Raw EVM deserialization error' AS message
        FROM v_accepted WHERE kind = 'raw' AND NOT ({RAW_OK})""",
    (V.V_ACTIONS,),
)
def raw_errors(spark, folder):
    actions = T.accepted(V.actions(spark, folder))
    _, bad = T.raw_transactions(actions, V.accounts(spark, folder), V.DELTA)
    return bad.select("block_num", "action_seq", "message")


@query(
    "translate_actions",
    """SELECT block_num, trx_index, gas AS gasused,
              CAST(sum(gas) OVER (PARTITION BY block_num ORDER BY trx_index) AS BIGINT) AS gasusedblock, kind
       FROM (SELECT *, CASE kind WHEN 'raw' THEN 21000 + event_id ELSE 21000 END AS gas FROM v_resolved
             WHERE (kind = 'raw' AND value < 120) OR (kind = 'withdraw' AND address IS NOT NULL)
                OR (kind = 'deposit' AND (memo_ok OR address IS NOT NULL)))""",
    (V.V_ACTIONS, V.V_ACCOUNTS, V_RESOLVED),
)
def translate_actions(spark, folder):
    good, _ = T.translate_actions(V.actions(spark, folder), V.accounts(spark, folder), V.DELTA)
    return good.select(
        "block_num",
        "trx_index",
        F.col("gasused").cast("bigint").alias("gasused"),
        F.col("gasusedblock").cast("bigint").alias("gasusedblock"),
        "kind",
    )


@query(
    "receipt_parse",
    """SELECT block_num, action_seq, CASE WHEN value > 140 THEN '' ELSE lower(to_hex(21000 + event_id)) END AS gasused,
              CASE WHEN value > 140 THEN -1 ELSE event_id END AS epoch, value <= 140 AS ok
       FROM v_actions WHERE kind = 'raw'""",
    (V.V_ACTIONS,),
)
def receipt_parse(spark, folder):
    raw = V.actions(spark, folder).where("name = 'raw'")
    parsed = raw.withColumn("r", T.parse_receipt(F.col("console")))
    return parsed.select(
        "block_num",
        "action_seq",
        F.coalesce("r.gasused", F.lit("")).alias("gasused"),
        F.coalesce("r.epoch", F.lit(-1)).cast("bigint").alias("epoch"),
        F.col("r").isNotNull().alias("ok"),
    )


# --- byte work ------------------------------------------------------------------


@query(
    "decode_raw",
    """SELECT block, trx_index, CAST(block AS VARCHAR) AS nonce, CAST(price AS VARCHAR) AS gas_price,
              CAST(gasused AS VARCHAR) AS gas_limit, '0x' || substr(hash, 1, 40) AS "to",
              lower(to_hex(part)) AS value_hex, '0' AS value_d, '0x' || hash AS data, line <> 7 AS signed,
              CASE WHEN line = 7 THEN '' ELSE '0x' || ltrim(hash, '0') END AS r
       FROM v_tx""",
    (V.V_TX,),
)
def decode_raw(spark, folder):
    txs = V.indexed(spark, folder)
    signed = F.col("line") != 7
    signature = lambda c: F.when(signed, c)
    encoded = codec.encode_legacy(
        F.col("block"),
        F.col("price"),
        F.col("gasused"),
        F.concat(F.lit("0x"), F.substring("hash", 1, 40)),
        F.lower(F.hex("part")),
        F.concat(F.lit("0x"), F.col("hash")),
        signature(F.lit("115")),
        signature(F.concat(F.lit("0x"), F.col("hash"))),
        signature(F.lit("0x1")),
    )
    decoded = T.decode_raw(txs.select("block", "trx_index", encoded.alias("tx")))
    return decoded.select(
        "block",
        "trx_index",
        "nonce",
        "gas_price",
        "gas_limit",
        "to",
        "value_hex",
        "value_d",
        "data",
        "signed",
        F.coalesce("r", F.lit("")).alias("r"),
    )


@query(
    "tx_hash_audit",
    "SELECT block, trx_index, line <> 5 AS ok FROM v_tx",
    (V.V_TX,),
)
def tx_hash_audit(spark, folder):
    """Hashes are stored rightly except on fifth lines, where another hash is stored."""
    fields = V.indexed(spark, folder).withColumns(
        {
            "nonce": F.col("block"),
            "gas_price": F.col("price"),
            "gas_limit": F.col("gasused"),
            "to": F.concat(F.lit("0x"), F.substring("hash", 1, 40)),
            "value_hex": F.lower(F.hex("part")),
            "input_data": F.concat(F.lit("0x"), F.col("hash")),
            "v": F.lit("115"),
            "r": F.concat(F.lit("0x"), F.col("hash")),
            "s": F.lit("0x1"),
        }
    )
    names = ("nonce", "gas_price", "gas_limit", "to", "value_hex", "input_data", "v", "r", "s")
    serialized = codec.encode_legacy(*[F.col(n) for n in names])
    right = F.concat(F.lit("0x"), codec.keccak_hex(H.from_hex(serialized)))
    stored = fields.withColumn(
        "hash", F.when(F.col("line") == 5, F.concat(F.lit("0x"), F.col("hash"))).otherwise(right)
    )
    return T.tx_hash_audit(stored).select("block", "trx_index", "ok")


BLOOM_ITEMS = """bloom_items AS (
  SELECT DISTINCT block, trx_index,
         unnest([substr(sha256('c' || supp), 1, 40), sha256('topic' || line), hash]) AS item FROM v_tx)"""


@query(
    "bloom_build",
    bloom_sql("block, trx_index", "bloom_items"),
    ("RECURSIVE " + V.V_TX, BLOOM_ITEMS, digest_views("bloom_items"), BITS),
)
def build_blooms(spark, folder):
    """Its SQL works the digests out by itself, round by round."""
    log = F.struct(
        F.substring(V.sha("c", F.col("supp").cast("string")), 1, 40).alias("address"),
        F.array(V.sha("topic", F.col("line").cast("string")), F.col("hash")).alias("topics"),
        F.lit("").alias("data"),
    )
    rows = V.indexed(spark, folder).withColumn("logs", F.array(log))
    return bloom_build(rows).select("block", "trx_index", "logs_bloom")


@query(
    "block_documents",
    """SELECT '{"@timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '","block_num":' || block_num
              || ',"@global":{"block_num":' || evm_block_num || '},"@blockHash":"' || native_hash
              || '","@evmBlockHash":"' || evm_hash || '","@evmPrevBlockHash":"' || evm_prev_hash
              || '","@receiptsRootHash":"' || receipts_root || '","@transactionsRoot":"' || transactions_root
              || '","gasUsed":"0","gasLimit":"2147483647","size":"' || size || '"}' AS document FROM v_blocks""",
    (V.V_BLOCKS,),
)
def block_documents(spark, folder):
    blocks = V.blocks(spark, folder).withColumns({"gas_used": F.lit(0), "gas_limit": F.lit(2147483647)})
    return documents.to_documents(blocks, "block")
