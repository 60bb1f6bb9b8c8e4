"""Words of a text and their hashes, as numpy arrays inside tasks.

``bytes.split()`` without arguments cuts at exactly space, tab, line feed, vertical tab, form feed and
carriage return, so ``text.encode().split()`` gives the runs of ``[^\\x20\\x09-\\x0D]+``, and
``bytes.lower()`` lowers A-Z only.
"""

from __future__ import annotations

import numpy as np
import xxhash

U64 = np.dtype("<u8")
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BACK = pow(_STEP, -1, 1 << 64)


def hashed(words: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes for each word, shape (n, 2)."""
    # hashing anew is faster than looking words up: vocabularies have long tails
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), dtype=U64).reshape(-1, 2)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits of the result are usable."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of all runs of ``width`` values, by prefix sums of ``value * STEP^position`` modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up), 4096)
            one = np.ones(1, U64)
            self.up = np.concatenate([one, np.cumprod(np.full(n - 1, _STEP, U64))])
            self.down = np.concatenate([one, np.cumprod(np.full(n - 1, _BACK, U64))])

    def hashes(self, values: np.ndarray, width: int | np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
        """Hash of ``values[s:s + width]`` for each start, all starts when none are given.  Each given start may
        have a width of its own."""
        n = len(values)
        if np.ndim(width) == 0 and n < width:
            return np.empty(0, U64)
        self._grow(n)
        sums = np.zeros(n + 1, U64)
        np.cumsum(values * self.up[:n], out=sums[1:])
        if starts is None:
            return mixed((sums[width:] - sums[:-width]) * self.down[:n - width + 1])
        return mixed((sums[starts + width] - sums[starts]) * self.down[starts])


def covered(n: int, starts: np.ndarray, width: int | np.ndarray) -> np.ndarray:
    """Which of n places lie in a run of ``width`` places from one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, n), -1)
    return np.cumsum(steps[:-1]) > 0
