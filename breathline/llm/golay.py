"""The perfect binary Golay code of 23 bits: the codewords near a word.

Every 23-bit word is within 3 bits of exactly one codeword. A word is given the numbers of
the codewords that it, or any word one bit away, decodes to: one number when its codeword
is within 2 bits, else six. Words up to 2 bits apart share a word one bit from each, and so
a number.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS, DATA_BITS, CHECK_BITS = 23, 12, 11
#: Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, which generates the code.
GENERATOR = 0xC75
TOLERANCE = 2


def remainder(word: int) -> int:
    for bit in range(BITS - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders by low and high bits of a word, and the error that a remainder stands for."""
    low = np.array([remainder(w) for w in range(1 << 12)], dtype=np.int64)
    high = np.array([remainder(w << 12) for w in range(1 << 11)], dtype=np.int64)
    error = np.zeros(1 << CHECK_BITS, dtype=np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(BITS), weight):
            word = sum(1 << b for b in bits)
            error[remainder(word)] = word
    return low, high, error


def decode(words: np.ndarray) -> np.ndarray:
    """The number of the codeword nearest to each word."""
    low, high, error = _tables()
    return (words ^ error[low[words & 0xFFF] ^ high[words >> 12]]) >> CHECK_BITS


def near_codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in ``words``, codeword numbers), each number of a word once."""
    flips = np.r_[0, 1 << np.arange(BITS, dtype=np.int64)]
    numbers = np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)
    fresh = np.ones(numbers.shape, dtype=bool)
    fresh[:, 1:] = numbers[:, 1:] != numbers[:, :-1]
    return np.nonzero(fresh)[0], numbers[fresh]
