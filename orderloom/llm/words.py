"""Hashes of words and of runs of words, for many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 3_000_000  # texts are hashed in blocks of about so many bytes; a longer text is a block alone

# \x20 and \x09 to \x0D end a word, and nothing else does; bytes.split() has the same rule
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_random = np.random.default_rng(20)
BYTE_VALUES = _random.integers(1, 2 ** 64, 256, np.uint64)
BYTE_VALUES[SPACE] = 0
RUN_FACTORS = _random.integers(1, 2 ** 64, 64, np.uint64) | np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of all texts, in order, and the number of words of each text."""
    joined = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    blank = SPACE[joined]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    gaps = np.diff(starts, append=len(joined))
    place = np.arange(starts[0], len(joined)) - np.repeat(starts, gaps)
    # a multiplier of its own for every place: powers of one number would let made-up words collide
    factors = mixed((np.arange(int(gaps.max()) + 1, dtype=np.uint64) + np.uint64(1)) * STEP) | np.uint64(1)
    values = BYTE_VALUES[joined[starts[0]:]] * factors[place]
    hashes = mixed(np.add.reduceat(values, starts - starts[0]))
    edges = np.cumsum([1] + [len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, edges))


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each word on; the last k - 1 words have none."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] * RUN_FACTORS[0]
    for i in range(1, k):
        total += words[i:n + i] * RUN_FACTORS[i]
    return mixed(total)


def whole_hash(words: np.ndarray) -> np.uint64:
    """One hash of a sequence of fewer words than RUN_FACTORS, apart from those of longer and shorter ones."""
    n = len(words)
    return mixed((words * RUN_FACTORS[-n:]).sum(dtype=np.uint64, keepdims=True) ^ np.array([n], np.uint64))[0]


def byte_blocks(texts: list[bytes]) -> Iterator[slice]:
    """Slices of a list of texts with about BLOCK_BYTES bytes each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK_BYTES:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))
