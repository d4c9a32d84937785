"""64-bit hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
S32, S29 = np.uint64(32), np.uint64(29)

# one random code for each byte, A-Z those of a-z
CODES = np.random.default_rng(20).integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CODES[65:91] = CODES[97:123]
BASE = np.uint64(0xD6E8FEB86659FD93)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2 ** 64))
_powers: list[np.ndarray] = [np.zeros(0, np.uint64)] * 2


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> S29)) * K2
    return h ^ (h >> S32)


def _power_tables(n: int) -> list[np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64 for i < n."""
    if len(_powers[0]) < n:
        for k, b in enumerate((BASE, BASE_INVERSE)):
            p = np.full(n + n // 4 + 1, b)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers


def _bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, null being empty, and where each text begins."""
    col = col.fill_null("").cast(pa.large_binary())
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


def _starts(blank: np.ndarray, at: np.ndarray) -> np.ndarray:
    edge = np.ones(len(blank) + 1, bool)        # a word may begin here
    edge[1:] = np.append(blank, True)[:len(blank)]
    edge[at] = True
    return np.flatnonzero(edge[:-1] & ~blank)


def word_counts(col: pa.Array, between: np.ndarray) -> np.ndarray:
    """Words of each text."""
    data, at = _bytes(col)
    return np.diff(np.searchsorted(_starts(between[data], at), at))


def word_hashes(col: pa.Array, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, the text it is in, and the texts' word counts; null is an empty text.

    ``between`` marks the bytes that part words. All texts are hashed at once:
    running sums of byte codes times powers of a base give any word's polynomial
    hash by one difference."""
    data, at = _bytes(col)
    blank = between[data]
    start = _starts(blank, at)
    stop = np.ones(len(data) + 1, bool)         # a word may end before here
    stop[:-1] = blank
    stop[at] = True
    end = np.flatnonzero(stop[1:] & ~blank) + 1
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(CODES[data] * up[:len(data)], out=total[1:])
    h = mixed((total[end] - total[start]) * down[start])
    doc = np.searchsorted(at[1:], start, "right")
    return h, doc, np.bincount(doc, minlength=len(col)).astype(np.int64)
