"""Arrow-batched byte work: legacy transaction codec, transaction hash, log bloom.

Built-in functions cannot express Keccak or the length-prefixed list encoding, so
these few columns go through Arrow UDFs. They are row-local: no shuffle, no state.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.hexes import pad_hex, strip_0x
from ledgerline.functions.keccak import keccak256, keccak256_array
from ledgerline.functions.rlp import decode_flat_list, encode_item, encode_list, encode_number

BLOOM_BYTES = 256

LEGACY = T.StructType(
    [
        T.StructField(name, T.StringType(), True)
        for name in ("nonce", "gas_price", "gas_limit", "to", "value_hex", "value_d", "data", "v", "r", "s")
    ]
    + [T.StructField("signed", T.BooleanType(), True), T.StructField("error", T.StringType(), True)]
)


DIGEST = T.StructType([T.StructField("hash", T.StringType()), T.StructField("size", T.LongType())])


def _digits(text: str) -> str:
    """Hex digits of decimal text or ``0x`` text."""
    return text[2:].lower() if text.startswith("0x") else f"{int(text):x}"


def _bytes(text: str) -> bytes:
    return bytes.fromhex(text[2:] if text.startswith("0x") else text)


def _data(text: str | None) -> str:
    if text is None:
        return ""
    return (text[2:] if text.startswith("0x") else text).lower()


def _rows(parts: pa.StructArray):
    """Rows of a struct of texts; NULL is None there."""
    return zip(*[_texts(column) for column in parts.flatten()])


def _texts(column: pa.Array) -> list:
    """``to_pylist`` of texts or bytes by way of NumPy, which is ten times as fast."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _encode(nonce, gas_price, gas_limit, to, value_hex, data, v, r, s) -> bytes:
    if None in (nonce, gas_price, gas_limit, value_hex):
        raise ValueError("missing field")
    signature = () if v is None else (v, r, s)
    return bytes.fromhex(
        encode_list(
            [
                encode_number(_digits(nonce)),
                encode_number(_digits(gas_price)),
                encode_number(_digits(gas_limit)),
                encode_item(_data(to)),
                encode_number(value_hex.lower()),
                encode_item(_data(data)),
                *[encode_number(_digits(part)) for part in signature],
            ]
        )
    )


def _plain_number(text: str) -> bytes:
    """Item of a plain decimal or ``0x`` number; whatever else is a ValueError."""
    if text.startswith("0x"):
        return _plain_hex(text[2:].lstrip("0"))
    if not (text.isascii() and text.isdigit()):
        raise ValueError("not plain")
    value = int(text)
    return _item(value.to_bytes((value.bit_length() + 7) // 8, "big"))


# Nonces, prices, limits and V repeat a lot; R and S don't.
_KNOWN: dict[str, bytes] = {}


def _repeated_number(text: str) -> bytes:
    found = _KNOWN.get(text)
    if found is None:
        if len(_KNOWN) >= 8192:
            _KNOWN.clear()
        found = _KNOWN[text] = _plain_number(text)
    return found


def _plain_hex(digits: str) -> bytes:
    if digits and not digits.isalnum():
        raise ValueError("not plain")
    return _item(bytes.fromhex(digits if len(digits) % 2 == 0 else "0" + digits))


def _plain_data(text: str | None) -> bytes:
    digits = "" if text is None else text[2:] if text.startswith("0x") else text
    if len(digits) % 2:
        raise ValueError("not plain")
    return _plain_hex(digits)


_HEADS = [bytes([0x80 + n]) for n in range(56)]


def _item(data: bytes) -> bytes:
    length = len(data)
    if length == 1 and data[0] < 0x80:
        return data
    if length < 56:
        return _HEADS[length] + data
    return bytes.fromhex(encode_item(data.hex()))


def _serialized(nonce, gas_price, gas_limit, to, value_hex, data, v, r, s) -> bytes:
    """As ``_encode``, which is left with the rows that hold anything unusual."""
    try:
        body = b"".join(
            (
                _repeated_number(nonce),
                _repeated_number(gas_price),
                _repeated_number(gas_limit),
                _plain_data(to),
                _plain_hex(value_hex.lstrip("0")),
                _plain_data(data),
            )
        )
        if v is not None:
            body += _repeated_number(v) + _plain_number(r) + _plain_number(s)
    except (ValueError, TypeError, AttributeError, OverflowError):
        return _encode(nonce, gas_price, gas_limit, to, value_hex, data, v, r, s)
    length = len(body)
    if length < 56:
        return bytes([0xC0 + length]) + body
    size = (length.bit_length() + 7) // 8
    return bytes([0xF7 + size]) + length.to_bytes(size, "big") + body


def _items(data: bytes) -> list[bytes]:
    """``decode_flat_list``, short for lists of short items, as almost all are."""
    end = len(data)
    first = data[0] if data else 0
    at = 1 if first < 0xF8 else first - 0xF6
    if first < 0xC0 or at > end or end - at != (first - 0xC0 if first < 0xF8 else int.from_bytes(data[1:at], "big")):
        return decode_flat_list(data)
    items = []
    while at < end:
        head = data[at]
        if head < 0x80:
            stop = at + 1
        elif head < 0xB8:
            at += 1
            stop = at + head - 0x80
        else:
            return decode_flat_list(data)
        if stop > end:
            return decode_flat_list(data)
        items.append(data[at:stop])
        at = stop
    return items


def _decode(text) -> tuple:
    if text is None:
        return (None,) * 12
    try:
        items = _items(_bytes(text))
        if len(items) not in (6, 9):
            raise ValueError(f"expected 6 or 9 values, got {len(items)}")
        numbers = [int.from_bytes(items[i], "big") for i in (0, 1, 2, 4)]
        to = "0x" + items[3].hex() if items[3] else None
        if to is not None and len(items[3]) != 20:
            raise ValueError("bad address length")
        v, r, s = (int.from_bytes(x, "big") for x in items[6:9]) if len(items) == 9 else (0, 0, 0)
        if max(numbers[3], r, s) >> 256:
            raise ValueError("number over 256 bits")
        signed = r != 0 or s != 0
        return (
            str(numbers[0]),
            str(numbers[1]),
            str(numbers[2]),
            to,
            f"{numbers[3]:x}",
            str(numbers[3] // 10**18),
            "0x" + items[5].hex(),
            str(v) if signed else None,
            f"0x{r:x}" if signed else None,
            f"0x{s:x}" if signed else None,
            signed,
            None,
        )
    except (ValueError, TypeError) as problem:
        return (None,) * 11 + (str(problem),)


@F.arrow_udf(LEGACY)
def _decode_udf(raw: pa.Array) -> pa.Array:
    columns = list(zip(*[_decode(text) for text in _texts(raw)])) or [()] * len(LEGACY.names)
    kinds = [pa.bool_() if name == "signed" else pa.string() for name in LEGACY.names]
    return pa.StructArray.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=LEGACY.names)


@F.arrow_udf(T.StringType())
def _encode_udf(parts: pa.Array) -> pa.Array:
    rows = _rows(parts)
    return pa.array([None if row[0] is None else "0x" + _serialized(*row).hex() for row in rows], type=pa.string())


@F.arrow_udf(DIGEST)
def _digest_udf(parts: pa.Array) -> pa.Array:
    messages, at = [], []
    hashes, sizes = [None] * len(parts), [None] * len(parts)
    for i, row in enumerate(_rows(parts)):
        try:
            messages.append(_serialized(*row))
            at.append(i)
        except (ValueError, TypeError, OverflowError):
            continue  # a field that is no number has no hash; the validators name it
    for i, message, digest in zip(at, messages, keccak256(messages)):
        hashes[i], sizes[i] = "0x" + digest.hex(), len(message)
    return pa.StructArray.from_arrays([pa.array(hashes, type=pa.string()), pa.array(sizes, type=pa.int64())], names=["hash", "size"])


@F.arrow_udf(T.StringType())
def _keccak_udf(data: pa.Array) -> pa.Array:
    digests = iter(keccak256(_texts(data.drop_null())))
    return pa.array([next(digests).hex() if p else None for p in data.is_valid().to_numpy(zero_copy_only=False)], type=pa.string())


@F.arrow_udf(T.StringType())
def _bloom_udf(items: pa.Array) -> pa.Array:
    # Contracts and topics repeat a lot: each distinct one is hashed once per batch.
    values = items.flatten().dictionary_encode()
    digests = keccak256_array([bytes.fromhex(item) if item is not None else b"" for item in values.dictionary.to_pylist()])
    sizes = np.asarray(items.value_lengths().fill_null(0))
    row = np.repeat(np.arange(len(items)), sizes)
    there = np.asarray(values.is_valid())
    row, item = row[there], np.asarray(values.indices.drop_null())
    blooms = np.zeros(len(items) * BLOOM_BYTES, dtype=np.uint8)
    for i in (0, 2, 4):  # the three bits an item's digest sets
        bit = (digests[:, i].astype(np.int64) * 256 + digests[:, i + 1]) % (8 * BLOOM_BYTES)
        byte, mask = BLOOM_BYTES - 1 - bit // 8, (1 << bit % 8).astype(np.uint8)
        np.bitwise_or.at(blooms, row * BLOOM_BYTES + byte[item], mask[item])
    text = blooms.tobytes().hex()
    width = 2 * BLOOM_BYTES
    return pa.array([text[n * width : (n + 1) * width] if size else None for n, size in enumerate(sizes)], type=pa.string())


@F.arrow_udf(T.ArrayType(T.LongType()))
def _words_udf(blooms: pa.Array) -> pa.Array:
    width = BLOOM_BYTES // 8
    whole = blooms.drop_null()
    words = np.frombuffer(b"".join(whole.to_pylist()), dtype=">i8").astype("<i8")
    ends = np.concatenate([[0], np.cumsum(np.asarray(blooms.is_valid()), dtype=np.int64)]) * width
    offsets = pa.array(ends, type=pa.int32(), mask=np.append(np.asarray(blooms.is_null()), False))
    return pa.ListArray.from_arrays(offsets, pa.array(words))


def bloom_words(data: Column) -> Column:
    """256 bytes as 32 LONGs; NULL gives NULL."""
    return _words_udf(data)


def decode_legacy(raw: Column) -> Column:
    """Serialized legacy transaction (hex text) to a struct; ``error`` says why not."""
    return _decode_udf(raw)


def encode_legacy(nonce, gas_price, gas_limit, to, value_hex, data, v=None, r=None, s=None) -> Column:
    """Hex text of the serialized transaction; without V, R, S the unsigned form.

    A row without nonce gives NULL.
    """
    return _encode_udf(_parts(nonce, gas_price, gas_limit, to, value_hex, data, v, r, s))


def legacy_digest(nonce, gas_price, gas_limit, to, value_hex, data, v, r, s) -> Column:
    """Struct of the transaction hash and the serialized size in bytes."""
    return _digest_udf(_parts(nonce, gas_price, gas_limit, to, value_hex, data, v, r, s))


def legacy_hash(nonce, gas_price, gas_limit, to, value_hex, data, v, r, s) -> Column:
    return legacy_digest(nonce, gas_price, gas_limit, to, value_hex, data, v, r, s)["hash"]


def _parts(nonce, gas_price, gas_limit, to, value_hex, data, v, r, s) -> Column:
    names = ("nonce", "gas_price", "gas_limit", "to", "value_hex", "data", "v", "r", "s")
    columns = (nonce, gas_price, gas_limit, to, value_hex, data, v, r, s)
    return F.struct(
        *[
            (F.lit(None) if column is None else column).cast("string").alias(name)
            for name, column in zip(names, columns)
        ]
    )


def keccak_hex(data: Column) -> Column:
    """Digest of a BINARY column as hex text."""
    return _keccak_udf(data)


def logs_bloom(logs: Column) -> Column:
    """Bloom over the address and all topics of an array of logs; NULL without logs."""

    def items(log: Column) -> Column:
        return F.concat(
            F.array(pad_hex(F.lower(strip_0x(log["address"])), 40)),
            F.transform(log["topics"], lambda topic: pad_hex(F.lower(strip_0x(topic)), 64)),
        )

    return _bloom_udf(F.flatten(F.transform(logs, items)))
