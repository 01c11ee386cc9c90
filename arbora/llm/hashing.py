"""64-bit hashes of words, whole texts at a time."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """64-bit hashes of all words of a text at once: differences of running sums of byte x power."""

    def __init__(self, separators: np.ndarray | None = None):
        """separators: for each byte, whether it parts words."""
        self.separators = np.isin(np.arange(256), [32, *range(9, 14)]) if separators is None else separators
        self.powers = self.inverse = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.powers):
            n = 1 << n.bit_length()
            base = np.full(n, 0x2545F4914F6CDD1D, np.uint64)
            base[0] = 1
            self.powers = base.cumprod(dtype=np.uint64)
            base[1:] = pow(0x2545F4914F6CDD1D, -1, 1 << 64)
            self.inverse = base.cumprod(dtype=np.uint64)

    def __call__(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of UTF-8 -> hashes of its words (runs without separators, 0x20 and 0x09-0x0D if none are named), and where they start."""
        space = self.separators[data]
        edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.grow(len(data) + 1)
        with np.errstate(over="ignore"):
            run = np.concatenate([np.zeros(1, np.uint64), ((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)]).cumsum(dtype=np.uint64)])
            return mixed_bits((run[end] - run[start]) * self.inverse[start] + (end - start).astype(np.uint64) * ODD), start


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
