"""The short ways of the codec against the general ones, on odd fields."""

import random

from pyspark.sql import functions as F

from ledgerline.functions import codec
from ledgerline.functions.keccak import CHUNK, keccak256
from ledgerline.functions.rlp import decode_flat_list

NUMBERS = ["0", "127", "128", "255", str(10**37), "0x", "0x00", "0x7f", "0xFF", "0xabc", "0x" + "ab" * 32, "-5", " 7 ", "1_0", "x", "", "٣", "0xzz", "0x 12", None]
DATA = [None, "", "0x", "ab", "0xAB", "abc", "0x" + "11" * 20, "0x" + "cd" * 60, "ab cd", "zz", "0x" + "ee" * 300]
VALUES = ["0", "00ff", "ABC", "", "7f", "80", "-1", "zz", " 1", "0x5", "f" * 64, None]


def tried(function, *args):
    try:
        return function(*args)
    except (ValueError, TypeError, AttributeError) as problem:
        return type(problem)


def test_short_encoding_and_decoding(spark):
    pick = random.Random(6)
    good = set()
    for _ in range(3000):
        n, d, v = (lambda items=items: pick.choice(items) for items in (NUMBERS, DATA, VALUES))
        row = (n(), n(), n(), d(), v(), d(), *pick.choice([(None,) * 3, (n(), n(), n())]))
        made = tried(codec._encode, *row)
        assert tried(codec._serialized, *row) == made
        if isinstance(made, bytes):
            good.add(made)
    assert len(good) > 50
    for data in [b"", b"\xc0", b"\xf8", b"\xf9\xff", b"\xff", b"\xc1\x80", b"\xc2\xc1\x01", *good]:
        for cut in (data, data[:-1], data + b"\0", data[:5] + b"\xb9" + data[6:]):
            assert tried(codec._items, cut) == tried(decode_flat_list, cut)


def test_digests_do_not_depend_on_the_chunk():
    messages = [i.to_bytes(4, "big") * (i % 80) for i in range(CHUNK + 500)]
    assert keccak256(messages) == [d for m in messages for d in keccak256([m])][: len(messages)]
    assert keccak256([b""])[0].hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"


def test_batches_with_nulls(spark):
    rows = [("00ff", ["ab", None], 1), (None, None, None), ("", [], 2), ("c0", ["ab", "cd"], None)]
    df = spark.createDataFrame(rows, "h string, items array<string>, n bigint").repartition(1)
    digest = codec.legacy_digest(F.col("n"), F.lit(1), F.lit(1), F.lit(None), F.lit("1"), F.lit(None), F.lit(None), F.lit(None), F.lit(None))
    made = df.select(codec.keccak_hex(F.unhex("h")), codec._bloom_udf(F.col("items")), digest["size"], codec.decode_legacy(F.col("h"))["error"]).collect()
    assert [r[0] is None for r in made] == [False, True, False, False]
    assert [r[1] is None for r in made] == [False, True, True, False]
    assert [r[2] for r in made] == [7, None, 7, None]
    assert [r[3] for r in made] == ["not one list", None, "truncated", "expected 6 or 9 values, got 0"]
    one, both = int(made[0][1], 16), int(made[3][1], 16)
    assert one & both == one and both.bit_count() > one.bit_count()
