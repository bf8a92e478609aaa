"""The binary Golay code (23, 12, 7): near words share a codeword.

Every 23-bit word lies within three errors of exactly one codeword. The keys of a
word are the codewords within four errors of it: one, or six for the words at
distance three. Words that differ in one bit share a key, because the codeword
nearest to one of them is at most four errors from the other.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

BITS, DATA_BITS, CHECK_BITS = 23, 12, 11

# Fixed value: the code's generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101

KEYS = 6


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome by bit position, and the error patterns of each syndrome (0 pads)."""
    by_bit = np.zeros(BITS, dtype=np.int64)
    for bit in range(BITS):
        rest = 1 << bit
        for high in range(BITS - 1, CHECK_BITS - 1, -1):
            if rest >> high & 1:
                rest ^= GENERATOR << (high - CHECK_BITS)
        by_bit[bit] = rest
    patterns: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(5):
        for bits in combinations(range(BITS), weight):
            syndrome = 0
            for bit in bits:
                syndrome ^= int(by_bit[bit])
            patterns[syndrome].append(sum(1 << bit for bit in bits))
    errors = np.array([(p + p[:1] * KEYS)[:KEYS] for p in patterns], dtype=np.int64)
    assert max(map(len, patterns)) == KEYS
    return by_bit, errors


def codeword_keys(words: np.ndarray) -> np.ndarray:
    """For each 23-bit word, the indices of its near codewords, as a (n, 6) array.

    A word with one near codeword has it six times.
    """
    by_bit, errors = _tables()
    words = np.asarray(words, dtype=np.int64)
    syndrome = np.zeros(len(words), dtype=np.int64)
    for bit in range(BITS):
        syndrome ^= np.where(words >> bit & 1, by_bit[bit], 0)
    return (words[:, None] ^ errors[syndrome]) >> CHECK_BITS
