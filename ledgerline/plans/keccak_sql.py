"""Log blooms in plain SQL: the sponge's rounds as a recursive query over 25 columns.

It shares nothing with ``functions.keccak``, so that blooms have an oracle of their own.
"""

from __future__ import annotations

# Fixed values of the permutation and of the sponge.
ROUNDS = 24
RATE = 136
ALL_ONES = 2**64 - 1


def round_constants() -> list[int]:
    """From the shift register ``x^8 + x^6 + x^5 + x^4 + 1``, seven bits a round."""
    out, state = [], 1
    for _ in range(ROUNDS):
        word = 0
        for j in range(7):
            if state & 1:
                word |= 1 << (2**j - 1)
            state = (state << 1) ^ (0x171 if state & 0x80 else 0)
        out.append(word)
    return out


def rotations() -> dict[tuple[int, int], int]:
    """How far the lane at (x, y) is turned."""
    out, x, y = {(0, 0): 0}, 1, 0
    for t in range(ROUNDS):
        out[x, y] = (t + 1) * (t + 2) // 2 % 64
        x, y = y, (2 * x + 3 * y) % 5
    return out


def _word(value: int) -> str:
    return f"'{value}'::UBIGINT"


def _turned(lane: str, by: int) -> str:
    """``lane`` rotated to the left, without a shift that may overflow."""
    if not by:
        return lane
    rest = _word(2 ** (64 - by))
    return f"(({lane} % {rest}) * {_word(2**by)} + {lane} // {rest})"


def _xor(*terms: str) -> str:
    out = terms[0]
    for term in terms[1:]:
        out = f"xor({out}, {term})"
    return out


def digest_views(items: str) -> str:
    """CTEs that end in ``digest(item, a0)``: the first eight bytes of the digest of every hex text of ``items(item)``.

    An item is shorter than 40 bytes, so it is one block of the sponge.
    """
    lanes = [f"a{i}" for i in range(25)]

    def lane(i: int) -> str:
        # bytes of a lane are little-endian
        return "('0x' || " + " || ".join(f"substr(padded, {16 * i + 2 * j + 1}, 2)" for j in reversed(range(8))) + ")::UBIGINT"

    last = RATE // 8 - 1
    absorbed = [lane(i) if i < 5 else _word(1 << 63) if i == last else _word(0) for i in range(25)]
    parity = [f"{_xor(*(f'a{x + 5 * y}' for y in range(5)))} AS c{x}" for x in range(5)]
    mixed = [f"{_xor(f'c{(x + 4) % 5}', _turned(f'c{(x + 1) % 5}', 1))} AS d{x}" for x in range(5)]
    moved = {}
    for (x, y), by in rotations().items():
        moved[y, (2 * x + 3 * y) % 5] = (x + 5 * y, x, by)
    lifted = [f"{_xor(f'a{i}', f'd{i % 5}')} AS e{i}" for i in range(25)]
    turned = [f"{_turned(f'e{source}', by)} AS b{x + 5 * y}" for (x, y), (source, _, by) in sorted(moved.items())]
    constants = "[" + ", ".join(_word(c) for c in round_constants()) + "]"
    out = []
    for i in range(25):
        x, y = i % 5, i // 5
        term = _xor(f"b{i}", f"(xor(b{(x + 1) % 5 + 5 * y}, {_word(ALL_ONES)}) & b{(x + 2) % 5 + 5 * y})")
        out.append(_xor(term, f"({constants})[turn + 1]") if i == 0 else term)
    return f"""sponge AS (
  SELECT item, 0 AS turn, {", ".join(f"{expr} AS a{i}" for i, expr in enumerate(absorbed))}
  FROM (SELECT item, rpad(item || '01', 80, '0') AS padded FROM (SELECT DISTINCT item FROM {items}))
  UNION ALL
  SELECT item, turn + 1, {", ".join(out)}
  FROM (SELECT item, turn, {", ".join(turned)}
  FROM (SELECT item, turn, {", ".join(lifted)}
  FROM (SELECT *, {", ".join(mixed)}
  FROM (SELECT item, turn, {", ".join(lanes)}, {", ".join(parity)} FROM sponge WHERE turn < {ROUNDS}))))),
digest AS (SELECT item, a0 FROM sponge WHERE turn = {ROUNDS})"""


#: ``bloom(item, bits)`` of ``digest``: three positions out of 2,048, each from two bytes.
BITS = """bloom_bits AS (
  SELECT item, unnest([((a0 % 256) % 8) * 256 + a0 // 256 % 256,
                       ((a0 // 65536 % 256) % 8) * 256 + a0 // 16777216 % 256,
                       ((a0 // 4294967296 % 256) % 8) * 256 + a0 // 1099511627776 % 256])::BIGINT AS bit
  FROM digest)"""


def bloom_sql(keys: str, items: str) -> str:
    """``keys, logs_bloom`` from the CTEs above and ``items(<keys>, item)``: set digits in their places, zeros between."""
    return f"""SELECT {keys}, string_agg(repeat('0', place - before - 1) || digit, '' ORDER BY place)
                      || repeat('0', CAST(511 - max(place) AS BIGINT)) AS logs_bloom
    FROM (SELECT *, coalesce(lag(place) OVER (PARTITION BY {keys} ORDER BY place), -1) AS before
          FROM (SELECT {keys}, 511 - bit // 4 AS place, printf('%x', CAST(bit_or(1 << CAST(bit % 4 AS INTEGER)) AS BIGINT)) AS digit
                FROM {items} JOIN bloom_bits USING (item) GROUP BY {keys}, 511 - bit // 4))
    GROUP BY {keys}"""
