"""Vectorised 64-bit hashes of runs of bytes or code points, by prefix sums of a polynomial modulo 2**64."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A value per symbol; code points above the table's size are mixed on the fly.
VALUES = mix(np.arange(1, 257, dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, kept for the next call."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 21)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _powers[name] = np.cumprod(row, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class Runs:
    """Prefix sums over an array of symbols; ``hashes(starts, ends)`` are equal for runs of equal symbols."""

    def __init__(self, symbols: np.ndarray):
        up, self.down = powers(len(symbols) + 1)
        values = VALUES[symbols] if symbols.dtype == np.uint8 else mix(symbols.astype(np.uint64) + np.uint64(1))
        values *= up[: len(symbols)]
        self.sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(values, out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def blank_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 text between blanks (space and 9 to 13)."""
    b = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = (b != 32) & ((b < 9) | (b > 13))
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
