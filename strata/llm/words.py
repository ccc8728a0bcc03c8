"""Words of many texts at once: byte-level splitting and 64-bit word hashes in numpy.

Two kinds of words, both on UTF-8 bytes: SPACED, runs of bytes other than ASCII white space;
PLAIN, runs of digits, ASCII letters (lower-cased) and non-ASCII bytes. Both are byte-wise, so
a multi-byte character never splits.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

U64 = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z count as letters: they are lower-cased by the hash table, or by LOWER.
OTHER = np.ones(256, bool)
OTHER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: The same as translation tables of bytes: separators become a space, A-Z lower case.
PLAIN_TABLE = bytes(32 if OTHER[i] else int(LOWER[i]) for i in range(256))
_BLOCK = 1 << 18
_BASE = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U64) * _BASE + U64(seed)) | U64(1)


_BYTES = seeds(256, 7)
_FOLDED = _BYTES[LOWER]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = U64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@dataclass
class Words:
    """Words of texts joined into ``data``: byte bounds of each, and each text's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text, and the total

    @property
    def text(self) -> np.ndarray:
        """The number of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        table, out = _FOLDED if lower else _BYTES, np.empty(len(self.starts), U64)
        at = 0
        while at < len(out):
            from_ = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, from_ + _BLOCK, side="right")))
            block = self.data[from_ : self.ends[to - 1]]
            n = _BLOCK if len(block) <= _BLOCK else len(block)
            up, down = _powers(n)
            sums = np.zeros(len(block) + 1, U64)
            np.cumsum(table[block] * up[: len(block)], out=sums[1:])
            s, e = self.starts[at:to] - from_, self.ends[at:to] - from_
            out[at:to] = (sums[e] - sums[s]) * down[np.minimum(s, n - 1)]
            at = to
        return mix(out)


def split(texts: list[bytes], separators: np.ndarray = WHITE) -> Words:
    """The words of each text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = ~separators[data]
    step = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return Words(data, starts, ends, np.searchsorted(starts, bounds))


def canonical(words: Words) -> tuple[bytes, np.ndarray]:
    """All words joined by one space, and where each starts there (with the end as last)."""
    n = words.ends - words.starts + 1
    at = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=at[1:])
    mark = np.zeros(len(words.data) + 1, np.int8)
    mark[words.starts] += 1
    mark[words.ends + 1] -= 1  # one separator follows each word
    joined = words.data[np.cumsum(mark[:-1], dtype=np.int8) > 0].copy()
    joined[at[1:] - 1] = 32
    return joined.tobytes(), at
