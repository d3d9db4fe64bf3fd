"""Hashes of many byte spans at once: no Python work for each word."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so its powers have inverses modulo 2**64


class SpanHasher:
    """64-bit hashes of spans of a byte array by prefix sums of a polynomial with random byte values."""

    def __init__(self) -> None:
        self._value = np.random.Generator(np.random.PCG64(20_240_607)).integers(1, 1 << 64, 256, np.uint64)
        self._power = self._inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._power) < n:
            n += 1 << 18
            self._power, self._inverse = (
                np.cumprod(np.append(np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)), dtype=np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64))
            )

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal for equal bytes, wherever they are. ``data``: uint8; the spans may overlap."""
        self._grow(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._value[data] * self._power[: len(data)], out=self._sums[1:])
        return self.spans(starts, ends)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of further spans of the data last given to `hashes`."""
        return mixed((self._sums[ends] - self._sums[starts]) * self._inverse[starts] + (ends - starts).astype(np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finaliser; fixed constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ragged(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices offset, offset + 1, ... of each run, one run after another."""
    ends = np.cumsum(lengths)
    return np.repeat(offsets - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
