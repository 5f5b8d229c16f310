import random

import pytest
from pyspark.sql import functions as F

from golden import LOGS_BLOOM, TRANSACTION
from ledgerline.functions import codec
from ledgerline.functions import hexes as H
from ledgerline.functions import text as X
from ledgerline.functions.keccak import keccak256

RAW = TRANSACTION["@raw"]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def apply(spark, values, expression, kind="string"):
    rows = column(spark, values, kind).select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [row.y for row in rows]


def test_keccak_known_digests():
    assert keccak256([b""])[0].hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    # The empty trie root is the digest of one encoded empty string.
    assert keccak256([b"\x80"])[0].hex() == "56e81f171bcc55a6ff8345e692c0f86e5b48e01b996cadc001622fb5e363b421"
    mixed = [bytes([i % 251]) * n for i, n in enumerate([0, 1, 135, 136, 137, 271, 272, 1000])]
    assert keccak256(mixed) == [keccak256([m])[0] for m in mixed]


def test_hash_of_the_golden_transaction(spark):
    names = ("nonce", "gas_price", "gas_limit", "to", "value", "input_data", "v", "r", "s")
    row = spark.createDataFrame([tuple(RAW[n] for n in names)], ", ".join(f"{n} string" for n in names))
    parts = [F.col(n) for n in names]
    made = row.select(
        codec.legacy_hash(*parts).alias("hash"), codec.encode_legacy(*parts).alias("raw")
    ).withColumn("d", codec.decode_legacy(F.col("raw")))
    got = made.first()
    assert got.hash == RAW["hash"]
    assert (got.d.nonce, got.d.gas_price, got.d.gas_limit) == ("184", RAW["gas_price"], RAW["gas_limit"])
    assert (got.d.to, got.d.data, got.d.value_hex) == (RAW["to"], RAW["input_data"], "0")
    assert (got.d.v, got.d.r, got.d.s, got.d.signed) == (RAW["v"], RAW["r"], RAW["s"], True)


def test_bloom_of_the_golden_transaction(spark):
    expected = LOGS_BLOOM
    logs = [[(log["address"], log["topics"], log["data"]) for log in RAW["logs"]], [], None]
    rows = spark.createDataFrame(
        [(i, x) for i, x in enumerate(logs)],
        "i int, logs array<struct<address:string,topics:array<string>,data:string>>",
    )
    got = [r.b for r in rows.select("i", codec.logs_bloom(F.col("logs")).alias("b")).orderBy("i").collect()]
    assert got == [expected, None, None]


def test_decoding_reports_bad_input(spark):
    got = apply(spark, ["0xc0", "zz", "0xc3010203", None, "0x"], lambda c: codec.decode_legacy(c)["error"])
    assert got[3] is None and all(got[i] for i in (0, 1, 2, 4))


def test_hex_plus_matches_big_integers(spark):
    random.seed(3)
    cases = [("f" * 64, 1), ("0" * 63 + "f", 1), ("0" * 49 + "f" * 15, 1), ("0" * 40 + "f" * 24, 77), ("0" * 64, 0)]
    cases += [(f"{random.getrandbits(256):064x}", random.getrandbits(40)) for _ in range(200)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, h string, n bigint")
    got = rows.select("i", H.hex_plus(F.col("h"), F.col("n")).alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == [f"{int(h, 16) + n:x}" for h, n in cases]


def test_decimal_and_hex_are_inverse(spark):
    random.seed(5)
    numbers = [0, 1, 2**64 - 1, 2**64, 2**126 - 1, 10**37] + [random.randrange(10**37) for _ in range(200)]
    texts = [str(n) for n in numbers]
    to_hex = apply(spark, texts, lambda c: H.decimal_to_hex(c.cast("decimal(38,0)")))
    assert to_hex == [f"{n:x}" for n in numbers]
    back = apply(spark, to_hex, H.hex_to_decimal)
    assert [int(b) if b is not None else None for b in back] == numbers
    assert apply(spark, ["", "0x", "xyz", "f" * 40], H.hex_to_decimal) == [None] * 4


def test_small_hex_functions(spark):
    assert apply(spark, ["0x00ab", "00", "0x"], H.unpad_hex) == ["0xab", "0x", "0x"]
    assert apply(spark, ["0x00ab", "00", "0x"], H.bare_hex) == ["ab", "0", "0"]
    assert apply(spark, ["abc", "abcdef"], lambda c: H.pad_hex(c, 5)) == ["00abc", "abcdef"]
    assert apply(spark, ["0xBEEF", "abc"], lambda c: H.to_hex(H.from_hex(c, strict=False))) == ["beef", ""]
    with pytest.raises(Exception, match="Invalid hex string"):
        apply(spark, ["abc"], H.from_hex)
    assert apply(spark, ["255", "0"], H.num_to_hex) == ["0xff", "0x0"]
    assert apply(spark, ["a" * 40000], lambda c: F.length(H.trim_input(c))) == [32000]


def test_synthetic_signature(spark):
    got = apply(
        spark,
        ["0x" + "00" * 20, "ABCD" + "0" * 36],
        lambda c: H.synthetic_vrs(F.lit("00" * 31 + "fe"), c, F.lit(3)),
    )
    assert [tuple(g) for g in got] == [("42", "0x101", "0x"), ("42", "0x101", "0xabcd" + "0" * 60)]


def test_assets(spark):
    texts = ["420.0000 SYS", " -1.5 A ", "7", "7. B", ".5 A", "abc", "12ABC"]
    got = apply(spark, texts, X.parse_asset)
    assert [tuple(g) if g else None for g in got] == [
        ("4200000", 4, "SYS"),
        ("-15", 1, "A"),
        ("7", 0, ""),
        ("7", 0, "B"),
        None,
        None,
        ("12", 0, "ABC"),
    ]
    wei = apply(spark, ["4200000", "9" * 24, "9" * 30], X.asset_to_wei)
    assert [str(w) if w is not None else None for w in wei] == ["420" + "0" * 18, str((10**24 - 1) * 10**14), None]
    whole = apply(spark, [str(420 * 10**18), str(10**18 - 1)], lambda c: X.wei_to_whole(c.cast("decimal(38,0)")))
    assert whole == ["420", "0"]


def test_account_names(spark):
    alphabet = ".12345abcdefghijklmnopqrstuvwxyz"

    def number(name):
        value = 0
        for i in range(13):
            symbol = max(alphabet.find(name[i]), 0) if i < len(name) else 0
            value |= symbol << (59 - 5 * i) if i < 12 else symbol & 15
        return value

    names = ["eosio.token", "alice", "a", "zzzzzzzzzzzzj", "1", "UPPER", "zzzzzzzzzzzzz", "abcdefghijkl", ""]
    got = [int(n) for n in apply(spark, names, X.name_to_uint64)]
    assert got == [number(n) for n in names]
    assert got[0] == 6138663591592764928


def test_validity_checks(spark):
    check = lambda f, values: apply(spark, values, f)
    assert check(X.is_integer, ["0", "-5", "05", "1e3", "", "12345678901234567890"]) == [True, True, False, False, False, True]
    assert check(X.is_hex, ["", "0x", "0xAb", "ab", "0xzz"]) == [True, True, True, True, False]
    assert check(X.is_bare_hex, ["", "0x", "ab"]) == [False, False, True]
    assert check(X.is_bare_address, ["a" * 40, "a" * 39, "g" * 40]) == [True, False, False]
    assert check(X.is_address, ["0x" + "a" * 40, "a" * 42]) == [True, False]
    assert check(X.is_bare_hash, ["a" * 64, "a" * 63]) == [True, False]
    assert check(X.is_hash, ["0x" + "a" * 64, "a" * 66, "a" * 64]) == [True, True, False]
    assert check(lambda c: X.is_hash(c, True), ["0x" + "a" * 64, "a" * 66]) == [True, False]
    assert check(X.is_asset, ["4.0000 SYS", "4 SYS", "SYS", "4.0 sys"]) == [True, True, False, False]
    assert check(X.is_timestamp, ["2022-05-04T03:48:49Z", "2022-05-02T22:42:51.500", "no"]) == [True, True, False]


def test_time_and_segments(spark):
    seconds = apply(spark, ["2022-05-02 22:42:51.500"], lambda c: X.epoch_seconds(c.cast("timestamp")))
    assert seconds == [1651531371]
    assert apply(spark, [9999999, 10000000], X.segment_of, "bigint") == [0, 1]
    assert apply(spark, [3], X.segment_label, "bigint") == ["00000003"]


def test_a_line_end_is_no_part_of_a_valid_text(spark):
    from ledgerline.functions import text as X

    checks = {
        "5": X.is_integer, "beef": X.is_bare_hex, "0x": X.is_hex, "ab" * 20: X.is_bare_address, "0x" + "ab" * 20: X.is_address,
        "cd" * 32: X.is_bare_hash, "0x" + "cd" * 32: lambda c: X.is_hash(c, strict=True), "1.5 SYS": X.is_asset,
    }
    for text, check in checks.items():
        df = spark.createDataFrame([(text,), (text + "\n",)], "t string")
        assert [r[0] for r in df.select(check(df.t)).collect()] == [True, False]
    memo = spark.createDataFrame([("0x" + "ab" * 20 + "\n", "cd" * 20)], "memo string, address string")
    assert memo.select(X.deposit_target(memo.memo, memo.address)).first()[0] == "0x" + "cd" * 20
