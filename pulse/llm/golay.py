"""Decoding with the perfect binary Golay code (23, 12, 7), vectorised.

Every 23-bit word lies within distance 3 of exactly one codeword.  The words
at distance 0 or 1 from a word decode to 1 or 6 different codewords; two words
at distance 2 or less have a common word in these balls and so share one of
these codewords.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
N, CHECK_BITS = 23, 11


def _remainder(word: int) -> int:
    for shift in range(N - 1, CHECK_BITS - 1, -1):
        if word >> shift & 1:
            word ^= GENERATOR << (shift - CHECK_BITS)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of single bytes by byte position, and the error pattern of each syndrome."""
    by_byte = np.array([[_remainder(b << 8 * p & (1 << N) - 1) for b in range(256)] for p in range(3)], dtype=np.int64)
    errors = np.zeros(1 << CHECK_BITS, dtype=np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(N), weight):
            pattern = sum(1 << b for b in bits)
            errors[_remainder(pattern)] = pattern
    return by_byte, errors


BY_BYTE, ERRORS = _tables()


def decode(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    w = words.astype(np.int64)
    syndrome = BY_BYTE[0][w & 255] ^ BY_BYTE[1][w >> 8 & 255] ^ BY_BYTE[2][w >> 16]
    return (w ^ ERRORS[syndrome]) >> CHECK_BITS


def ball_indices(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codeword indices of each word and its one-bit neighbours in the low ``bits`` bits.

    Returns the sorted indices (n, bits + 1) and a mask of first occurrences.
    """
    flips = np.concatenate([[0], 1 << np.arange(bits, dtype=np.int64)])
    found = np.sort(decode(words.astype(np.int64)[:, None] ^ flips[None, :]), axis=1)
    fresh = np.ones(found.shape, dtype=bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    return found, fresh
