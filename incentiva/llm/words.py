"""Words of whole texts as arrays: positions, 64-bit hashes, shingles.

A word is a run of ASCII letters (lower-cased), ASCII digits and any characters
beyond ASCII. Work is on UTF-8 bytes: all of these bytes are word bytes, so no
text is decoded and no Python object is made per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_U = np.uint64
_MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[ord("0"): ord("9") + 1] = True
IS_WORD[ord("a"): ord("z") + 1] = True
IS_WORD[ord("A"): ord("Z") + 1] = True
IS_WORD[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every input bit changes every output bit."""
    x = (x + _U(0x9E3779B97F4A7C15)).astype(_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Doubles in (0, 1) from mixed 64-bit values."""
    return ((x >> _U(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


_BYTE = mix(np.arange(256, dtype=_U))
_R = 0x9FB21C651E98DF25  # odd, so it has an inverse modulo 2**64
_R_INV = pow(_R, -1, 1 << 64)
_POW: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**i and R**-i for i < n, kept between calls."""
    if len(_POW[0]) < n:
        for k, r in enumerate((_R, _R_INV)):
            steps = np.full(n, r, _U)
            steps[0] = 1
            _POW[k] = np.cumprod(steps, dtype=_U)
    return _POW[0], _POW[1]


@dataclass
class Words:
    """start, end: byte positions in the joined text; doc: row number; hash: one per word."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    count: np.ndarray  # words of each row


def split_words(raw: np.ndarray, at: np.ndarray, hashes: bool = True) -> Words:
    """The words of rows whose bytes are raw[at[i]:at[i+1]]."""
    n_rows, size = len(at) - 1, len(raw)
    word = np.zeros(size + 2, np.int8)
    word[1:-1] = IS_WORD[raw]
    first = np.zeros(size + 1, bool)
    first[at] = True  # a row's first byte never continues the word of the row before
    is_word = word[1:-1].astype(bool)
    starts = np.flatnonzero(is_word & ((word[:-2] == 0) | first[:-1]))
    ends = np.flatnonzero(is_word & ((word[2:] == 0) | first[1:])) + 1
    per_row = np.diff(np.searchsorted(starts, at))
    doc = np.repeat(np.arange(n_rows), per_row)
    h = np.zeros(0, _U)
    if hashes:
        up, down = _powers(size + 1)
        total = np.zeros(size + 1, _U)
        np.cumsum(_BYTE[LOWER[raw]] * up[:size], dtype=_U, out=total[1:])
        h = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))
    return Words(starts, ends, doc, h, per_row)


_STEP = [_U(int(x) | 1) for x in mix(np.arange(1000, 1064, dtype=_U))]


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each run of ``size`` words; a row with fewer words, but not none, has one shingle."""
    n_rows = len(w.count)
    first = np.zeros(n_rows + 1, np.int64)
    np.cumsum(w.count, out=first[1:])
    n = np.where(w.count >= size, w.count - size + 1, 0)
    rows = np.repeat(np.arange(n_rows), n)
    begin = np.zeros(n_rows, np.int64)
    begin[1:] = np.cumsum(n)[:-1]
    at = first[rows] + np.arange(len(rows)) - begin[rows]
    h = np.zeros(len(rows), _U)
    for k in range(size):
        h += w.hash[at + k] * _STEP[k]
    short = np.flatnonzero((w.count > 0) & (w.count < size))
    if len(short):
        extra = np.zeros(len(short), _U)
        for k in range(size - 1):
            there = w.count[short] > k
            extra[there] += w.hash[first[short[there]] + k] * _STEP[k]
        rows = np.concatenate([rows, short])
        h = np.concatenate([h, extra + w.count[short].astype(_U)])
        order = np.argsort(rows, kind="stable")
        rows, h = rows[order], h[order]
    return rows, mix(h)
