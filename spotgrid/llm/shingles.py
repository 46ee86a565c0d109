r"""Word shingles as 64-bit hashes, with numpy.

Words are runs without \x20 and \x09 to \x0D after A-Z are lower-cased. A text's set holds the hash of every run of k
words; a text of fewer words has one element, its whole sequence; one without words has none.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(11)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 14)
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, x, np.uint64)])) for x in (_STEP, _BACK)]
    return _POWERS[0], _POWERS[1]


def word_hashes(text: str) -> np.ndarray:
    """One number per word: a polynomial in its bytes, the same wherever the word stands."""
    data = np.frombuffer(text.encode().translate(_LOWER), np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)])])
    return mix((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(k, len(words))
    n = len(words) - size + 1
    key = np.full(n, size, np.uint64)
    for i in range(size):
        key += words[i : i + n] * _PLACE[i]
    return np.unique(mix(key))
