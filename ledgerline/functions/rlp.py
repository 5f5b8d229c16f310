"""The list encoding of legacy transactions (small per-row helpers)."""

from __future__ import annotations


# Everything is put together as hex text: columns hold hex, and joining text is cheap.
_ITEM = [f"{0x80 + n:02x}" for n in range(56)]


def _long_header(length: int, offset: int) -> str:
    size = f"{length:x}"
    size = size if len(size) % 2 == 0 else "0" + size
    return f"{offset + 55 + len(size) // 2:02x}{size}"


def encode_item(digits: str) -> str:
    """Byte string, given and returned as hex."""
    length = len(digits) // 2
    if length == 1 and digits < "80":
        return digits
    if length < 56:
        return _ITEM[length] + digits
    return _long_header(length, 0x80) + digits


def encode_number(digits: str) -> str:
    """Integer given as hex digits, leading zeros allowed."""
    digits = digits.lstrip("0")
    return encode_item(digits if len(digits) % 2 == 0 else "0" + digits)


def encode_list(items: list[str]) -> str:
    body = "".join(items)
    length = len(body) // 2
    return (f"{0xC0 + length:02x}" if length < 56 else _long_header(length, 0xC0)) + body


def _span(data: bytes, at: int) -> tuple[int, int, bool]:
    """(start, end, is list) of the item at ``at``."""
    if at >= len(data):
        raise ValueError("truncated")
    first = data[at]
    if first < 0x80:
        return at, at + 1, False
    is_list = first >= 0xC0
    short = first - (0xC0 if is_list else 0x80)
    start, length = at + 1, short
    if short > 55:
        start = at + 1 + short - 55
        if start > len(data):
            raise ValueError("truncated")
        length = int.from_bytes(data[at + 1 : start], "big")
    if start + length > len(data):
        raise ValueError("truncated")
    return start, start + length, is_list


def decode_flat_list(data: bytes) -> list[bytes]:
    """Items of a list that holds byte strings only."""
    at, end, is_list = _span(data, 0)
    if not is_list or end != len(data):
        raise ValueError("not one list")
    items = []
    while at < end:
        start, stop, nested = _span(data, at)
        if nested:
            raise ValueError("nested list")
        items.append(data[start:stop])
        at = stop
    return items
