import json

import pytest
from pyspark.sql import functions as F

from golden import TRANSACTION
from ledgerline import schemas as S
from ledgerline.functions import codec
from ledgerline.operators import actions as A
from ledgerline.operators import translate as T
from ledgerline.operators import totals

RAW = TRANSACTION["@raw"]
BLOCK_ID = "00" * 31 + "10"
ALICE = "aa" * 20
DATA = ("from", "to", "quantity", "memo", "tx", "sender")


def action(seq, account="eosio.token", name="transfer", receiver="eosio.evm", block=50, digest=None, console="", **data):
    return (
        block,
        block,
        BLOCK_ID,
        None,
        seq,
        account,
        name,
        receiver,
        digest or f"d{seq}",
        "ab" * 32,
        seq + 1,
        console,
        tuple(data.get("sender_" if k == "from" else k) for k in DATA),
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, S.ACTIONS)


def accounts(spark):
    return spark.createDataFrame(
        [("alice", ALICE), ("bob", "bb" * 20), ("bob", "cc" * 20)], "account string, address string"
    )


def transfer(seq, quantity="420.0000 SYS", memo="", sender_="alice", to="eosio.evm", **more):
    return action(seq, quantity=quantity, memo=memo, sender_=sender_, to=to, **more)


def withdraw(seq, to="alice", quantity="1.5000 SYS"):
    return action(seq, "eosio.evm", "withdraw", to=to, quantity=quantity)


def receipt(**changes):
    body = {
        "status": 1,
        "epoch": 1651531371,
        "itxs": [],
        "logs": RAW["logs"],
        "errors": [],
        "output": "",
        "gasused": "7f00",
        "gasusedblock": "",
        "charged_gas": f"{499809179185:x}",
        "createdaddr": "",
        **changes,
    }
    return "noise RCPT{{" + json.dumps(body) + "}}RCPT noise"


def signed_tx(spark):
    names = ("nonce", "gas_price", "gas_limit", "to", "value", "input_data", "v", "r", "s")
    row = spark.createDataFrame([tuple(RAW[n] for n in names)], ", ".join(f"{n} string" for n in names))
    return row.select(codec.encode_legacy(*[F.col(n) for n in names]).alias("tx")).first().tx


def test_kinds_and_first_copies(spark):
    rows = [
        transfer(0),
        transfer(1, receiver="alice"),  # notice to another account
        transfer(2, to="carol"),  # no deposit
        withdraw(3),
        action(4, "eosio.msig", "exec"),  # listed, but of no kind
        action(5, "other", "raw"),
        action(6, "eosio.evm", "raw", tx="00"),
        transfer(7, digest="d0"),
        transfer(8, sender_="eosio"),
    ]
    df = frame(spark, rows)
    kinds = {r.action_seq: r.kind for r in A.classify_actions(df).collect()}
    assert kinds == {0: "deposit", 3: "withdraw", 6: "raw", 7: "deposit", 8: "deposit"}
    indexed = T.accepted(df).orderBy("trx_index").collect()
    assert [(r.action_seq, r.trx_index) for r in indexed] == [(0, 0), (3, 1), (6, 2), (8, 3)]
    assert 8 not in {r.action_seq for r in A.classify_actions(df, ["eosio"]).collect()}


def test_deposit(spark):
    good, bad = T.translate_actions(frame(spark, [transfer(0)]), accounts(spark), 2)
    row = good.first()
    assert bad.count() == 0
    assert row.to == "0x" + ALICE and row["from"] == "0x" + "00" * 20
    assert row.value_hex == f"{420 * 10**18:x}" and row.value_d == "420.0000 SYS"
    assert (row.v, row.r, row.s) == ("42", "0x10", "0x")
    assert (row.gasused, row.gasusedblock, row.gas_price, row.gas_limit) == (21000, 21000, 0, 21000)
    assert (row.block, row.block_num, row.trx_index, row.input_data) == (48, 50, 0, "0x")
    assert len(row.hash) == 66


def test_targets_and_errors(spark):
    rows = [
        transfer(0, memo="0x" + "AB" * 20, sender_="nobody"),
        transfer(1, memo="0xshort"),
        transfer(2, memo="0xshort", sender_="nobody"),
        transfer(3, memo="hi", sender_="nobody"),
        transfer(4, sender_="bob"),  # two rows for bob
        transfer(5, quantity="many SYS"),
        transfer(6, quantity="-1.0000 SYS"),
        withdraw(7),
        withdraw(8, to="nobody"),
    ]
    good, bad = T.translate_actions(frame(spark, rows), accounts(spark), 2)
    assert {r.trx_index: (r["from"], r.to, r.gasusedblock) for r in good.collect()} == {
        0: ("0x" + "00" * 20, "0x" + "ab" * 20, 21000),
        1: ("0x" + "00" * 20, "0x" + ALICE, 42000),
        7: ("0x" + ALICE, "0x" + "00" * 20, 63000),
    }
    assert {r.action_seq: r.message for r in bad.collect()} == {
        2: "User deposited to an invalid address",
        3: "User deposited without registering",
        4: "User deposited without registering",
        5: "Asset must begin with a number",
        6: "amount out of range",
        8: "failed to get eth addr for nobody, int: 11317340220547923968",
    }
    everything = T.translate(T.accepted(frame(spark, rows)), accounts(spark), 2)
    assert sum(r.hash is None for r in everything.collect()) == 6
    info = json.loads(bad.where("action_seq = 2").first().info)
    assert info["nativeBlockHash"] == BLOCK_ID and info["block_num"] == 48 and info["tx"]["memo"] == "0xshort"


def test_fail_fast(spark):
    df = frame(spark, [transfer(0, sender_="nobody")])
    good, _ = T.translate_actions(df, accounts(spark), 2, fail_fast=True)
    with pytest.raises(Exception, match="User deposited without registering"):
        good.collect()


def test_signed_raw_transaction_matches_the_golden_document(spark):
    row = action(0, "eosio.evm", "raw", console=receipt(), tx=signed_tx(spark), sender_=RAW["from"])
    good, bad = T.translate_actions(frame(spark, [row]), accounts(spark), 36)
    assert bad.count() == 0
    got = good.first()
    assert got.hash == RAW["hash"] and got["from"] == RAW["from"] and got.to == RAW["to"]
    assert (got.v, got.r, got.s) == (RAW["v"], RAW["r"], RAW["s"])
    assert got.input_data == TRANSACTION["@raw"]["input_data"] == got.input_trimmed
    assert (got.gasused, got.charged_gas_price, got.epoch, got.status) == (32512, 499809179185, 1651531371, 1)
    assert got.errors is None and got.itxs == [] and got.logs[0].address == RAW["logs"][0]["address"]
    audit = T.tx_hash_audit(good).first()
    assert audit.ok and audit.recomputed == RAW["hash"]
    assert not T.tx_hash_audit(good.withColumn("nonce", F.col("nonce") + 1)).first().ok


def test_unsigned_raw_and_its_errors(spark):
    unsigned = (
        spark.range(1)
        .select(codec.encode_legacy(F.lit(1), F.lit(2), F.lit(3), F.lit("0x" + "ee" * 20), F.lit("ff"), F.lit("0x")).alias("tx"))
        .first()
        .tx
    )
    raw = lambda seq, **kw: action(seq, "eosio.evm", "raw", **kw)
    itx = {"callType": "0", "input": "ab" * 20000, "traceAddress": [0, 2], "extra": {"a": [1]}}
    rows = [
        raw(0, tx=unsigned, sender="AB" * 20, console=receipt(itxs=[itx], logs=[], errors=["boom"])),
        raw(1, tx=unsigned, sender="0x12", console=receipt()),
        raw(2, tx=unsigned, sender="AB" * 20, console=""),
        raw(3, tx=unsigned, sender="AB" * 20, console="RCPT{{ {broken }}RCPT"),
        raw(4, tx="c3010203", sender="AB" * 20, console=receipt()),
        raw(5, tx=unsigned, sender="AB" * 20, console=receipt(gasused="")),
        raw(6, tx=unsigned, sender="AB" * 20, console="no receipt at all"),
    ]
    good, bad = T.translate_actions(frame(spark, rows), accounts(spark), 2)
    got = good.collect()
    assert [r.trx_index for r in got] == [0]
    row = got[0]
    assert row["from"] == "0x" + "ab" * 20 and (row.v, row.s) == ("42", "0x" + "ab" * 20 + "0" * 24)
    assert row.value_hex == "ff" and row.logs is None and row.logs_bloom is None and row.errors == ["boom"]
    assert len(row.itxs[0].input_trimmed) == 32000 and json.loads(row.itxs[0].extra) == {"a": [1]}
    messages = {r.action_seq: r.message for r in bad.collect()}
    assert messages.pop(2) == "consoleLog undefined or empty string"
    assert messages == {n: "Raw EVM deserialization error" for n in (1, 3, 4, 5, 6)}
    detail = json.loads(bad.where("action_seq = 1").first().info)["error"]
    assert detail == "error deserializing address '0x12'"


def test_very_large_blocks_give_the_same_result(spark):
    rows = [transfer(i, block=50) for i in range(120)] + [transfer(i, block=51) for i in range(5)]
    df = frame(spark, rows)
    plain, _ = T.translate_actions(df, accounts(spark), 2)
    cut, _ = T.translate_actions(df, accounts(spark), 2, width=20)
    pick = lambda d: sorted(map(tuple, d.select("block_num", "trx_index", "hash", "gasusedblock").collect()))
    assert pick(plain) == pick(cut)
    assert max(r[1] for r in pick(cut)) == 119


def test_odd_positions_in_cut_blocks(spark):
    seqs = {50: [None, None, 0, 1, 4, 7, 8], 51: [5] * 7, 52: [0, 1], 53: [0, 9], 54: [-1, 0]}
    rows = [transfer(i, block=block) for block, own in seqs.items() for i in range(len(own))]
    places = F.create_map(*[F.lit(x) for block, own in seqs.items() for i, seq in enumerate(own) for x in (f"{block} {i}", seq)])
    df = frame(spark, rows).withColumn("action_seq", places[F.concat_ws(" ", "block_num", "action_seq")].cast("bigint"))
    parts = A.in_several_parts(A.classify_actions(df), 3).groupBy("block_num").count().collect()
    assert {tuple(r) for r in parts} == {(50, 7), (51, 7), (53, 2), (54, 2)}
    good, _ = T.translate_actions(df, accounts(spark), 2, width=3)
    got = sorted((r.block_num, r.trx_index, int(r.gasusedblock)) for r in good.collect())
    assert got == [(block, i, 21000 * (i + 1)) for block, own in seqs.items() for i in range(len(own))]


def test_a_receipt_is_parsed_once(spark):
    good, _ = T.translate_actions(frame(spark, [action(0, "eosio.evm", "raw", tx="00", console=receipt())]), accounts(spark), 2)
    plan = good.select("block_num", "trx_index", "gasusedblock")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2  # the blocks, and those of several parts


def test_block_assembly_and_reindex(spark):
    rows = [transfer(i) for i in range(3)]
    txs, _ = T.translate_actions(frame(spark, rows), accounts(spark), 2)
    headers = spark.createDataFrame(
        [(50, "2022-05-02 22:42:51.5", "AB" * 32), (51, "2022-05-02 22:42:52", "cd" * 32)],
        "block_num bigint, ts string, native_hash string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    made = {r.block_num: r for r in totals.assemble_blocks(headers, txs, 2, F.col("raw_size")).collect()}
    assert (made[50].tx_count, made[50].gas_used, made[50].evm_block_num) == (3, 63000, 48)
    assert made[50].native_hash == "ab" * 32 and made[50].ts.microsecond == 0
    sizes = [r.raw_size for r in txs.collect()]
    assert made[50].size == sum(sizes)
    assert (made[51].tx_count, made[51].gas_used, made[51].size) == (0, 0, 0)
    assert made[51].logs_bloom == "0" * 512

    blocks = totals.assemble_blocks(
        headers.withColumn("evm_hash", F.concat(F.lit("h"), "block_num")), txs, 2, F.col("raw_size")
    )
    again, moved = totals.reindex_blocks(blocks, txs.drop("raw_size", "kind", "action_seq"), 2, 50, 50)
    assert [tuple(r) for r in again.select("block_num", "gas_used", "tx_count", "evm_hash").collect()] == [
        (50, 63000, 3, "h50")
    ]
    assert {r.block_hash for r in moved.collect()} == {"h50"}
    assert totals.genesis_block(blocks.limit(1), 2).first().evm_prev_hash == "0" * 64
