"""The binary Golay code of length 23: every word lies within three bits of exactly one codeword."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS, DATA = 23, 12
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a divisor of x^23 + 1


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator: 0 for codewords."""
    rest = words.astype(np.int64)
    for bit in range(BITS - 1, BITS - DATA - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - BITS + DATA)), rest)
    return rest


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error pattern, and the patterns from the word to its nearby codewords.

    A word at distance three has five more codewords at distance four. Row by syndrome:
    the nearest codeword's pattern first, then those five, or -1.
    """
    nearest = np.zeros(1 << (BITS - DATA), np.int64)
    patterns = [sum(1 << b for b in some) for n in range(4) for some in combinations(range(BITS), n)]
    nearest[syndrome(np.array(patterns))] = patterns
    near = np.full((len(nearest), 6), -1, np.int64)
    near[:, 0] = nearest
    four = np.array([sum(1 << b for b in some) for some in combinations(range(BITS), 4)])
    of_four = syndrome(four)
    order = np.argsort(of_four, kind="stable")
    at = np.searchsorted(of_four[order], np.arange(len(nearest) + 1))
    for s in range(len(nearest)):
        if int(nearest[s]).bit_count() == 3:
            near[s, 1:] = four[order[at[s] : at[s + 1]]]
    return nearest, near


def nearby_indices(words: np.ndarray) -> np.ndarray:
    """Indices (the upper 12 bits) of the codewords near each word: one or six, -1 for none.

    Two words that differ in at most two bits share an index: if either is within two bits
    of its codeword, that codeword is nearby for both; otherwise both are at distance three,
    and a codeword at distance four from both exists, or the same one is nearest.
    """
    patterns = tables()[1][syndrome(words)]
    return np.where(patterns >= 0, (words[:, None] ^ patterns) >> (BITS - DATA), -1)
