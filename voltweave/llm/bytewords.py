"""Words of UTF-8 texts, found and hashed with NumPy over the bytes of many texts at once."""

from __future__ import annotations

import numpy as np

_DRAW = np.random.default_rng(20240229)
_BYTE = _DRAW.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Powers of the base, and of its inverse modulo 2^64; grown to the longest array seen.
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, np.uint64(pow(int(_BASE), -1, 2**64)))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def lower_bytes(text: str | None) -> bytes:
    """UTF-8 of the text with A-Z in lower case; null is empty, what isn't valid becomes a question mark."""
    return (text or "").encode("utf-8", "replace").lower()


def words(raw: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each word of the bytes; space tells by byte value what parts words."""
    if not len(raw):
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space[raw], [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    power, inverse = _powers(len(raw) + 1)
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[raw] * power[:-1], out=sums[1:])
    return start, end, mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


class Lookup:
    """A fixed map of 64-bit keys to values, read for whole arrays at once. Keys are distinct and none has all bits set."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.levels, rest, turn = [], np.arange(len(keys)), 0
        while len(rest):
            bits = max(4, int(2 * len(rest)).bit_length())
            factor = np.uint64(int(mix(np.array([turn + 1], np.uint64))[0]) | 1)
            slot = ((keys[rest] * factor) >> np.uint64(64 - bits)).astype(np.int64)
            held = np.full(1 << bits, -1)
            held[slot] = rest
            full = held >= 0
            k, v = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64), np.zeros(1 << bits, values.dtype)
            k[full], v[full] = keys[held[full]], values[held[full]]
            self.levels.append((factor, np.uint64(64 - bits), k, v))
            rest, turn = rest[held[slot] != rest], turn + 1

    def get(self, keys: np.ndarray, default: float = 0.0) -> np.ndarray:
        out, todo = np.full(len(keys), default), None
        for factor, shift, k, v in self.levels:
            asked = keys if todo is None else keys[todo]
            slot = ((asked * factor) >> shift).astype(np.int64)
            hit = k[slot] == asked
            at = np.flatnonzero(hit)
            out[at if todo is None else todo[at]] = v[slot[at]]
            miss = np.flatnonzero(~hit)
            todo = miss if todo is None else todo[miss]
            if not len(todo):
                break
        return out
