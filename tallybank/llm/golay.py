"""The perfect binary Golay code [23, 12, 7]: nearest codewords of 23-bit words by syndrome tables.

Every 23-bit word lies within 3 bits of exactly one codeword. A word at distance 3 from it has five more codewords at
distance 4, a nearer word has none. So if two words differ in at most one bit, the nearest codeword of either is among
the codewords within 4 bits of the other: one bit more than 3 reaches it.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np

LENGTH, CHECKS = 23, 11
GENERATOR = 0b101011100011                       # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
NEAR_KEYS = 6


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of the words, read as polynomials, by the generator."""
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        rest ^= ((rest >> bit) & 1) * (GENERATOR << (bit - CHECKS))
    return rest


@functools.cache
def error_tables() -> np.ndarray:
    """By syndrome, the error patterns of up to 4 bits: first the lightest one; -1 fills the places of nearer words."""
    table = np.full((1 << CHECKS, NEAR_KEYS), -1, dtype=np.int64)
    filled = np.zeros(1 << CHECKS, dtype=np.int64)
    weight_of = np.full(1 << CHECKS, 9)
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in bits) for bits in itertools.combinations(range(LENGTH), weight)])
        for pattern, syndrome in zip(patterns.tolist(), syndromes(patterns).tolist()):
            table[syndrome, filled[syndrome]] = pattern
            filled[syndrome] += 1
            weight_of[syndrome] = min(weight_of[syndrome], weight)
    assert set(filled[weight_of == 3]) == {NEAR_KEYS} and set(filled[weight_of < 3]) == {1}
    return table


def near_indices(words: np.ndarray) -> np.ndarray:
    """Per word, the 12-bit indices of all codewords within 4 bits, the nearest first; -1 where there are fewer."""
    errors = error_tables()[syndromes(words)]
    return np.where(errors < 0, -1, (words.astype(np.int64)[:, None] ^ np.maximum(errors, 0)) >> CHECKS)
