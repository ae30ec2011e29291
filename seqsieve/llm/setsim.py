"""Sets of 64-bit hashes: word shingles of texts, MinHash values, and exact overlaps of pairs in a block."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

from .words import WORD_BYTES, hashes, lower_ascii, mix, rolling, spans

SHINGLE, THRESHOLD = 5, (4, 5)
#: Columns of a block's incidence matrix that are held at once.
COLUMNS = 16384


def needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least overlap of sets of sizes a and b whose Jaccard similarity is THRESHOLD or more."""
    top, bottom = THRESHOLD
    return -(-(a + b) * top // (top + bottom))


def shingles(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the rows' five-word shingles in order, and their rows. One to four words are one shingle."""
    body = lower_ascii(body)
    starts, ends, rows = spans(body, offsets, WORD_BYTES)
    word = hashes(body, starts, ends)
    found, of = rolling(word, rows, SHINGLE)
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    few = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(few):
        n = counts[few]
        first = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(first, n)
        mixed = mix(word[np.repeat(np.searchsorted(rows, few), n) + place] * (2 * place + 3).astype(np.uint64))
        short = np.add.reduceat(mixed, first) + n.astype(np.uint64)
        at = np.searchsorted(of, few)
        found, of = np.insert(found, at, mix(short)), np.insert(of, at, few)
    return found, of


def sets_of(found: np.ndarray, of: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each of n rows."""
    cut = np.searchsorted(of, np.arange(n + 1))
    return [np.unique(found[cut[i] : cut[i + 1]]) for i in range(n)]


def fingerprint(values: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    a = mix(values + np.uint64(0x51ED270B)).sum(dtype=np.uint64)
    b = mix(values ^ np.uint64(0x7F4A7C159E3779B9)).sum(dtype=np.uint64) + np.uint64(len(values))
    return int(mix(np.array([a]))[0].astype(np.int64)), int(mix(np.array([b]))[0].astype(np.int64))


_RANDOM = np.random.RandomState(1234567)
_FACTORS = (_RANDOM.randint(0, 2**31, 512, dtype=np.int64) * 2 + 1).astype(np.uint32)


def minhash(sets: list[np.ndarray], k: int) -> np.ndarray:
    """k MinHash values of each set, which must not be empty."""
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), k), np.uint32)
    for i in range(k):
        v = (low ^ (high >> np.uint32(i % 13))) * _FACTORS[i]
        v ^= v >> np.uint32(16)
        v *= np.uint32(0x85EBCA6B)
        v += high * _FACTORS[511 - i]
        v ^= v >> np.uint32(15)
        out[:, i] = np.minimum.reduceat(v * np.uint32(0xC2B2AE35), at)
    return out


@lru_cache(maxsize=None)
def least_matches(n: int, tolerance: float) -> int:
    """Fewest of n equal MinHash values for which, under a uniform prior, the similarity still reaches the threshold
    with a posterior probability of `tolerance` or more."""
    t, below = THRESHOLD[0] / THRESHOLD[1], 0.0
    for m in range(n + 1):
        below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        if below >= tolerance:
            return m
    return n + 1


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets, exactly: one by one if pairs are few, else by matrix products."""
    if len(left) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left.tolist(), right.tolist(), strict=True)], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts >= 2
    number = np.cumsum(shared) - 1
    keep = shared[column]
    column, owner = number[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        total += held @ held.T
    return np.rint(total[left, right]).astype(np.int64)


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs reach the threshold, after a length filter."""
    sizes = np.array([len(s) for s in sets], np.int64)
    a, b = sizes[left], sizes[right]
    need = needed(a, b)
    may = np.flatnonzero(np.minimum(a, b) >= need)
    out = np.zeros(len(left), bool)
    if len(may):
        out[may] = overlaps(sets, left[may], right[may]) >= need[may]
    return out
