"""The perfect binary Golay code of 23 bits as a fuzzy hash.

Every vector lies within three bits of exactly one codeword, whose twelve message bits are its index. A vector three
bits from its codeword has five more codewords at four bits; it gets all six indices. Two vectors that differ in one
bit then share an index: if they have different nearest codewords, these are at least seven bits apart, so the vectors
are three and four bits from the one they share.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11

#: Generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (a fixed value).
GENERATOR = 0b101011100011


def remainder(vector: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if vector >> bit & 1:
            vector ^= GENERATOR << bit - CHECKS
    return vector


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of each bit; for each remainder the error patterns that lead to near codewords, -1 where none."""
    bits = np.array([remainder(1 << b) for b in range(LENGTH)], dtype=np.int64)
    errors = np.full((1 << CHECKS, 6), -1, dtype=np.int64)
    used = np.zeros(1 << CHECKS, dtype=np.int64)
    for weight in range(5):
        for chosen in combinations(range(LENGTH), weight):
            at = 0
            for b in chosen:
                at ^= int(bits[b])
            errors[at, used[at]] = sum(1 << b for b in chosen)
            used[at] += 1
    return bits, errors


BIT_REMAINDER, ERRORS = _tables()


def indices(vectors: np.ndarray) -> np.ndarray:
    """The one or six codeword indices of each 23-bit vector, as rows of six, -1 where there are fewer."""
    at = np.zeros(len(vectors), dtype=np.int64)
    for b in range(LENGTH):
        at ^= np.where(vectors >> b & 1, BIT_REMAINDER[b], 0)
    errors = ERRORS[at]
    return np.where(errors < 0, -1, (vectors[:, None] ^ errors) >> CHECKS)
