"""Vectorised words, word hashes and rolling k-gram hashes of a text buffer (numpy, for use inside tasks)."""

from __future__ import annotations

import numpy as np

_BLOCK = 1 << 18
_rng = np.random.default_rng(20240611)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_KGRAM = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW = _powers(int(_BASE), _BLOCK + 1)
_INV = _powers(pow(int(_BASE), -1, 1 << 64), _BLOCK + 1)

#: A random 64-bit value for each byte; A-Z have those of a-z.
FOLDED = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED[0x41:0x5B] = FOLDED[0x61:0x7B]

#: Bytes of words: all but white space; and digits, letters and everything beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(buf: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``buf``, and the row it is in; a word ends where its row does."""
    inside = table[buf]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    edge = at[:-1][at[:-1] < len(buf)]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[edge[edge > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A-Z taken as a-z: a polynomial over random byte values, from prefix sums."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = int(np.searchsorted(ends, lo + _BLOCK, "right"))
        if j == i:  # one word longer than a block: block by block
            h, p = np.uint64(0), np.uint64(1)
            with np.errstate(over="ignore"):
                for a in range(lo, ends[i], _BLOCK):
                    b = min(a + _BLOCK, ends[i])
                    h = h + p * (FOLDED[buf[a:b]] * _POW[: b - a]).sum(dtype=np.uint64)
                    p = p * _POW[_BLOCK]
            out[i] = h
            i += 1
            continue
        sums = np.zeros(ends[j - 1] - lo + 1, np.uint64)
        np.cumsum(FOLDED[buf[lo: ends[j - 1]]] * _POW[: len(sums) - 1], out=sums[1:])
        out[i:j] = (sums[ends[i:j] - lo] - sums[starts[i:j] - lo]) * _INV[starts[i:j] - lo]
        i = j
    return mix(out ^ mix((ends - starts).astype(np.uint64)))


def kgram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of words i to i+k-1, for each i (rows are not looked at)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out *= _KGRAM
        out += words[j: j + n]
    return mix(out)


def char_hashes(buf: np.ndarray, q: int, values: np.ndarray = FOLDED) -> np.ndarray:
    """Hash of the q bytes from each position on."""
    n = len(buf) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    v = values[buf]
    out = v[:n].copy()
    for j in range(1, q):
        out *= _BASE
        out += v[j: j + n]
    return mix(out)
