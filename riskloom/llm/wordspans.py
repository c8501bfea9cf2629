"""Words of many texts at once, as places in one byte array.

Texts stay in the Arrow buffer they came in: a word is a (start, length) pair, its hash
is XXH64 computed for all words of one length together, and equality is decided on the
bytes. Nothing here makes a Python object per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

# The five multipliers of XXH64.
P1, P2, P3, P4, P5 = map(np.uint64, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
#: Words of this many bytes or more are hashed one by one.
LONG = 32
#: Bytes compared at once.
STRIDE = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in one of the ranges, both ends included."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Digits, a-z and every byte of a character beyond ASCII; for texts in lower case.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a string column one after the other, and where each begins (one more: the end). Null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every maximal run of `letters` bytes inside one text, and the number of its text."""
    inside = letters[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = inside[begins]
    last[begins[begins > 0] - 1] = inside[begins[begins > 0] - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(offsets, starts, side="right") - 1


def _turn(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint64(bits)) | (h >> np.uint64(64 - bits))


def _short(rows: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of the rows of a byte matrix of fewer than LONG columns."""
    n, size = rows.shape
    h = np.full(n, P5 + np.uint64(size) + np.uint64(seed))
    at = 0
    for at in range(0, size - 7, 8):
        lane = np.ascontiguousarray(rows[:, at : at + 8]).view("<u8").ravel()
        h = _turn(h ^ (_turn(lane * P2, 31) * P1), 27) * P1 + P4
    at = size // 8 * 8
    if size - at >= 4:
        lane = np.ascontiguousarray(rows[:, at : at + 4]).view("<u4").ravel().astype(np.uint64)
        h = _turn(h ^ (lane * P1), 23) * P2 + P3
        at += 4
    for at in range(at, size):
        h = _turn(h ^ (rows[:, at].astype(np.uint64) * P5), 11) * P1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of each byte range, as unsigned 64-bit numbers."""
    out = np.zeros(len(starts), np.uint64)
    order = np.argsort(np.minimum(lengths, LONG).astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(np.minimum(lengths, LONG), minlength=LONG + 1))
    with np.errstate(over="ignore"):
        for size in range(LONG):
            own = order[(ends[size - 1] if size else 0) : ends[size]]
            if len(own):
                out[own] = _short(data[starts[own][:, None] + np.arange(size)], seed)
    for i in order[ends[LONG - 1] : ends[LONG]]:
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]].tobytes(), seed)
    return out


def same_bytes(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each pair of byte ranges of one positive length, whether they hold the same bytes."""
    out = np.zeros(len(lengths), bool)
    total = np.cumsum(lengths)
    cuts = np.unique(np.searchsorted(total, np.arange(0, int(total[-1]) if len(total) else 0, STRIDE)))
    for low, high in zip(cuts, [*cuts[1:], len(lengths)]):
        own = lengths[low:high]
        begins = np.cumsum(own) - own
        steps = np.arange(int(own.sum())) - np.repeat(begins, own)
        equal = a[np.repeat(a_starts[low:high], own) + steps] == b[np.repeat(b_starts[low:high], own) + steps]
        out[low:high] = np.logical_and.reduceat(equal, begins)
    return out
