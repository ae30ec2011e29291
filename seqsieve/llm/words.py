"""Words of UTF-8 text and their 64-bit hashes, by numpy over raw bytes: no Python object for a word."""

from __future__ import annotations

import numpy as np

_SEED = np.random.RandomState(20240229)
_BYTE = _SEED.randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_SEED.randint(0, 2**62, dtype=np.int64)) * 4 + 3
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size, known = 1, np.ones(1, np.uint64)
        while size < n:
            known = np.concatenate([known, known * np.uint64(pow(base, size, 2**64))])
            size *= 2
        if size <= 1 << 23:
            _POWERS[base] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA24BAED4963EE407)
    return h ^ (h >> np.uint64(32))


def lower_ascii(body: np.ndarray) -> np.ndarray:
    return np.where((body >= 65) & (body <= 90), body + np.uint8(32), body)


#: Bytes of words: all but ASCII control characters, spaces and punctuation.
WORD_BYTES = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
#: Bytes of pre-tokens: all but white space.
DARK_BYTES = np.array([c not in (32, 9, 10, 11, 12, 13) for c in range(256)])


def spans(body: np.ndarray, offsets: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the longest runs of bytes of a kind; no run crosses a row."""
    inside = of[body]
    before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
    edges = offsets[1:-1]
    edges = edges[edges < len(body)]
    first = inside & ~before
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    last = inside & ~np.concatenate([inside[1:], [False]]) if len(inside) else inside
    ends_at = edges[edges > 0] - 1
    last[ends_at] = inside[ends_at]
    cut = np.searchsorted(starts, offsets)  # few offsets in many starts; of equal ones the last row has the runs
    cut[-1] = len(starts)
    return starts, np.flatnonzero(last) + 1, np.repeat(np.arange(len(offsets) - 1), np.diff(cut))


def hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal for equal bytes, wherever they stand."""
    n = len(body)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[body] * _powers(_BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))


def rolling(h: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k neighbouring words and their rows, in order; the order of the words counts."""
    if len(h) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(h) - k + 1
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = (total * np.uint64(_BASE)) + h[i : i + n]
    keep = rows[:n] == rows[k - 1 :]
    return mix(total[keep]), rows[:n][keep]
