"""Words and hashes of many texts at once, as numpy arrays."""

from __future__ import annotations

import numpy as np

from seatrace.llm.common import ships_by_value

U64 = np.uint64
#: An odd multiplier, so that it has an inverse modulo 2**64.
BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all 64 bits; one to one."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A random number for every byte, so that sums of powers do not follow the alphabet.
BYTE_CODE = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


class Powers:
    """Powers of BASE and of its inverse, as long as was needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            ones = np.ones(size, np.uint64)
            ones[1:] = BASE
            self.up = np.multiply.accumulate(ones)
            ones[1:] = BASE_INVERSE
            self.down = np.multiply.accumulate(ones)
        return self.up[:n], self.down[:n]


class Hasher:
    """64-bit hashes of any spans of one sequence of codes."""

    def __init__(self, codes: np.ndarray, powers: Powers) -> None:
        up, self.down = powers.upto(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[:-1], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, n: int) -> np.ndarray:
        """Hashes of all spans of length ``n``, by start."""
        count = max(0, len(self.sums) - n)
        return mixed((self.sums[n : n + count] - self.sums[:count]) * self.down[:count])


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~IS_BLANK[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words; the length goes into the hash."""
    starts, ends = word_spans(data)
    hashes = Hasher(BYTE_CODE[data], powers).spans(starts, ends)
    return starts, ends, mixed(hashes + (ends - starts).astype(np.uint64) * BASE)


ships_by_value(__name__)
