import copy
import json

from pyspark.sql import functions as F

from golden import BLOCK, TRANSACTION
from ledgerline.operators import feed, validate
from ledgerline.sources import documents


def load(spark, folder, docs, kind):
    path = f"{folder}/{kind}"
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").write.text(path)
    return documents.read_documents(spark, path, kind)


def changed(document, **raw):
    made = copy.deepcopy(document)
    made["@raw"].update(raw)
    return made


def test_golden_documents_are_valid(spark, folder):
    txs = load(spark, folder, [TRANSACTION], "transaction")
    assert validate.validate_tx(txs).first().violations == []
    assert validate.validate_tx(txs, strict=True).first().violations == []
    assert validate.with_storable(txs, "transaction").first().storable
    blocks = load(spark, folder, [BLOCK], "block")
    row = validate.validate_blocks(blocks).first()
    assert row.violations == [] and row.shape == "block"


def test_every_broken_rule_is_named(spark, folder):
    docs = [
        changed(TRANSACTION, nonce="0x1", hash="0x12", value="0x0"),
        changed(TRANSACTION, to=None, createdaddr="ab", value_d="420.0000 SYS"),
        {**TRANSACTION, "trx_id": "short", "@timestamp": "no time"},
    ]
    checked = validate.validate_tx(load(spark, folder, docs, "transaction"))
    assert sorted(r.violations for r in checked.collect()) == [
        ["createdaddr"],
        ["hash", "value_hex", "nonce"],
        ["ts", "trx_id"],
    ]
    good, quarantine = validate.split_valid(checked)
    assert good.count() == 0 and quarantine.count() == 3


def test_genesis_is_storable_without_a_body(spark, folder):
    genesis = {k: v for k, v in BLOCK.items() if k in ("@timestamp", "block_num", "@global", "@blockHash", "@evmBlockHash", "@evmPrevBlockHash")}
    broken = {**genesis, "@evmBlockHash": "xyz"}
    other = {"create": {"_index": "x"}}
    flat = load(spark, folder, [genesis, broken, other], "block")
    shapes = [r.shape for r in validate.validate_blocks(flat).collect()]
    assert sorted(shapes) == ["genesis", "invalid", "invalid"]
    assert sorted(r.shape for r in validate.validate_blocks(flat, genesis_ok=False).collect()) == ["invalid"] * 3
    assert sum(r.storable for r in validate.with_storable(flat, "block").collect()) == 1


def test_documents_round_trip(spark, folder):
    flat = load(spark, folder, [TRANSACTION], "transaction")
    typed = documents.typed_transactions(flat, 36)
    row = typed.first()
    assert (row.block_num, row.segment, row.gas_price) == (213195291, 21, 549790097103)
    assert validate.validate_tx(typed).first().violations == []
    back = json.loads(documents.to_documents(typed, "transaction").first().document)
    expected = copy.deepcopy(TRANSACTION)
    assert back == expected
    blocks = documents.typed_blocks(load(spark, folder, [BLOCK], "block"))
    again = json.loads(documents.to_documents(blocks, "block").first().document)
    assert again == {k: v for k, v in BLOCK.items() if k not in ("code", "table")}


def test_feed_messages(spark, folder):
    blocks = documents.typed_blocks(load(spark, folder, [BLOCK], "block")).withColumn("logs_bloom", F.lit("0" * 512))
    txs = spark.createDataFrame(
        [(213404613, 0, "0xa", 100), (213404613, 1, "0xb", 355)], "block bigint, trx_index bigint, hash string, gasusedblock bigint"
    )
    sent = feed.in_sending_order(feed.head_feed(blocks, txs)).collect()
    assert [m.type for m in sent] == ["raw", "raw", "head"]
    assert json.loads(sent[1].message)["data"]["hash"] == "0xb"
    head = json.loads(sent[2].message)["data"]
    assert head["number"] == hex(213404613) and head["gasUsed"] == hex(355)
    assert head["timestamp"] == hex(1651636129) and head["hash"] == "0x" + BLOCK["@evmBlockHash"]
    assert head["parentHash"] == "0x" + BLOCK["@evmPrevBlockHash"] and head["gasLimit"] == "0x7fffffff"
