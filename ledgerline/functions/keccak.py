"""Keccak-256 of many messages at once, on NumPy 64-bit lanes.

Spark has no Keccak. Each of the 25 state lanes is one array over all messages of an
chunk of an Arrow batch, so a permutation round is a handful of array operations for the batch.
"""

from __future__ import annotations

import numpy as np

RATE = 136  # bytes absorbed per permutation for a 256-bit digest
CHUNK = 2048  # messages hashed together: their lanes fit a core's cache
CHUNK_BYTES = 32 * 2**20  # padded bytes hashed together


def _round_constants() -> list[int]:
    """The 24 iota constants, from the degree-8 LFSR x^8+x^6+x^5+x^4+1."""
    constants, register = [], 1
    for _ in range(24):
        value = 0
        for j in range(7):
            if register & 1:
                value |= 1 << ((1 << j) - 1)
            register = (register << 1) ^ (0x171 if register >> 7 else 0)
        constants.append(value)
    return constants


def _rho_pi() -> list[tuple[int, int, int]]:
    """(source lane, target lane, left rotation) of the combined rho and pi steps."""
    moves, x, y = [(0, 0, 0)], 1, 0
    for t in range(24):
        target = (y, (2 * x + 3 * y) % 5)
        moves.append((x + 5 * y, target[0] + 5 * target[1], ((t + 1) * (t + 2) // 2) % 64))
        x, y = target
    return moves


IOTA = [np.uint64(c) for c in _round_constants()]
MOVES = [(source, target, np.uint64(bits), np.uint64(64 - bits)) for source, target, bits in _rho_pi()]
ONE, REST = np.uint64(1), np.uint64(63)


def _permute(lanes: np.ndarray) -> None:
    """One permutation, in place, of 25 lanes, each a row over the messages."""
    n = lanes.shape[1]
    moved, spare = np.empty_like(lanes), np.empty(n, dtype=np.uint64)
    parity, turned, theta, other = (np.empty((5, n), dtype=np.uint64) for _ in range(4))
    planes, new = lanes.reshape(5, 5, n), moved.reshape(5, 5, n)
    for constant in IOTA:
        np.bitwise_xor.reduce(planes, axis=0, out=parity)
        np.left_shift(parity, ONE, out=turned)
        np.right_shift(parity, REST, out=other)
        turned |= other
        for x in range(5):
            np.bitwise_xor(parity[x - 1], turned[(x + 1) % 5], out=theta[x])
        planes ^= theta
        moved[0] = lanes[0]
        for source, target, bits, back in MOVES[1:]:
            np.left_shift(lanes[source], bits, out=moved[target])
            np.right_shift(lanes[source], back, out=spare)
            moved[target] |= spare
        for x in range(5):
            np.invert(new[:, (x + 1) % 5], out=other)
            other &= new[:, (x + 2) % 5]
            np.bitwise_xor(new[:, x], other, out=planes[:, x])
        lanes[0] ^= constant


def _chunks(groups: dict[int, list[int]]):
    for blocks, members in groups.items():
        width = max(1, min(CHUNK, CHUNK_BYTES // (blocks * RATE)))
        for start in range(0, len(members), width):
            yield blocks, members[start : start + width]


def keccak256_array(messages: list[bytes]) -> np.ndarray:
    """Digest of each message, 32 bytes a row. Messages of equal block count are hashed together."""
    digests = np.zeros((len(messages), 32), dtype=np.uint8)
    groups: dict[int, list[int]] = {}
    for i, message in enumerate(messages):
        groups.setdefault(len(message) // RATE + 1, []).append(i)
    for blocks, members in _chunks(groups):
        size = blocks * RATE
        taken = [messages[i] for i in members]
        lengths = np.fromiter(map(len, taken), dtype=np.int64, count=len(taken))
        data = np.frombuffer(bytearray(b"".join([m.ljust(size, b"\0") for m in taken])), dtype=np.uint8)
        start = np.arange(len(taken)) * size
        data[start + lengths] ^= 0x01
        data[start + size - 1] ^= 0x80
        words = data.view("<u8").reshape(len(taken), blocks, RATE // 8)
        lanes = np.zeros((25, len(taken)), dtype=np.uint64)
        for block in range(blocks):
            lanes[: RATE // 8] ^= words[:, block, :].T
            _permute(lanes)
        digests[members] = np.ascontiguousarray(lanes[:4].T).astype("<u8").view(np.uint8)
    return digests


def keccak256(messages: list[bytes]) -> list[bytes]:
    data = keccak256_array(messages).tobytes()
    return [data[at : at + 32] for at in range(0, len(data), 32)]
