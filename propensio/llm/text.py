"""Vectorised word hashing, shared by the operators that work on shingles.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 text with A-Z lower-cased. A word's
hash is a polynomial over its bytes (mod 2^64, random byte values), taken from
prefix sums, so one text costs a few numpy passes and no Python loop per word.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = int(_RNG.integers(1, 2**61)) * 8 + 5
_Q = int(_RNG.integers(1, 2**61)) * 8 + 3
_P_INV = pow(_P, -1, 2**64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_PIECE = 1 << 20
_powers: dict[int, np.ndarray] = {}


def _pow(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod 2^64, kept for the longest n asked for."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 14), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _piece_words(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, dtype=np.uint8)
    inside = ~_SPACE[a]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    sums = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[a] * _pow(_P, len(a)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _pow(_P_INV, len(a))[starts])


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of every word in order; empty for a null or blank text."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    raw = text.encode("utf-8", "surrogatepass").lower()  # bytes.lower changes A-Z only
    if len(raw) <= _PIECE:
        return _piece_words(raw)
    pieces, at = [], 0
    while at < len(raw):  # cut long texts at white space, so the power tables stay small
        end = at + _PIECE
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        pieces.append(_piece_words(raw[at:end]))
        at = end
    return np.concatenate(pieces)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words in order; fewer words make one run, none make none."""
    n = len(words)
    if not n:
        return words
    take = min(width, n)
    q = _pow(_Q, take)
    total = np.zeros(n - take + 1, dtype=np.uint64)
    for j in range(take):
        total += words[j : n - take + 1 + j] * q[j]
    if n < width:
        total += np.uint64(0x9E3779B97F4A7C15 * n % 2**64)
    return mix(total)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of the whole text."""
    return np.unique(shingles(word_hashes(text), width))
