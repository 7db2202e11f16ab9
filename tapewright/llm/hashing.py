"""Hashes of words and byte strings of many texts at once, by prefix sums over the texts' joined bytes.

The hash of a stretch is sum(T[byte] * P**place) with 64-bit wrap-around, shifted to place 0 by P's inverse, then mixed.
T holds a fixed pseudo-random number for each byte, so equal stretches have equal hashes wherever they stand.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa

from .shared import mix64

_P = np.uint64(0x9E3779B97F4A7C4B)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_T = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _T.copy()
_FOLDED[65:91] = _T[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PUNCTUATION = _SPACE.copy()
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
#: Powers are kept for so many places, and once for each block of them, so their size doesn't follow the texts' sizes.
_BLOCK = 1 << 16
#: Words are hashed in pieces of about so many bytes.
PIECE_BYTES = 4 << 20


def _first_powers(base: np.uint64) -> np.ndarray:
    held = np.ones(1, np.uint64)
    while len(held) < _BLOCK:
        held = np.concatenate([held, held * np.uint64(int(held[-1]) * int(base) % (1 << 64))])
    return held


_SMALL = {int(base): _first_powers(base) for base in (_P, _P_INVERSE)}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The powers of _P or _P_INVERSE from 0 on."""
    blocks = np.array([pow(int(base), k * _BLOCK, 1 << 64) for k in range(-(-n // _BLOCK))], np.uint64)
    return (blocks[:, None] * _SMALL[int(base)]).ravel()[:n]


def powers_at(base: np.uint64, places: np.ndarray) -> np.ndarray:
    """The powers of _P or _P_INVERSE at any places."""
    last = int(places.max()) // _BLOCK if len(places) else 0
    blocks = np.array([pow(int(base), k * _BLOCK, 1 << 64) for k in range(last + 1)], np.uint64)
    return blocks[places >> 16] * _SMALL[int(base)][places & (_BLOCK - 1)]


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and each text's bounds there; null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, ends, data = texts.buffers()
    bounds = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


class PrefixHash:
    """Hashes of any stretches of one run of bytes."""

    def __init__(self, data: np.ndarray, folded: bool = False) -> None:
        n, of_byte = len(data), _FOLDED if folded else _T
        self.sums = np.zeros(n + 1, np.uint64)
        for a in range(0, n, _BLOCK):
            part = of_byte[data[a : a + _BLOCK]] * _SMALL[int(_P)][: min(_BLOCK, n - a)]
            np.cumsum(part * np.uint64(pow(int(_P), a, 1 << 64)), out=self.sums[a + 1 : a + 1 + len(part)])
            self.sums[a + 1 : a + 1 + len(part)] += self.sums[a]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * powers_at(_P_INVERSE, starts))

    def windows(self, size: int) -> np.ndarray:
        """The hash of each stretch of that size, by its start."""
        n = max(0, len(self.sums) - size)
        return mix64((self.sums[size:] - self.sums[:n]) * powers(_P_INVERSE, n)) if n else np.zeros(0, np.uint64)


def words(data: np.ndarray, bounds: np.ndarray, bare: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (stretch without white space), and each text's bounds among the words.

    bare: ASCII punctuation parts words as white space does.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    solid = ~(_PUNCTUATION if bare else _SPACE)[data]
    first = np.empty(len(data), bool)
    first[0], first[1:] = True, ~solid[:-1]
    first[bounds[:-1][bounds[:-1] < len(data)]] = True
    last = np.empty(len(data), bool)
    last[-1], last[:-1] = True, ~solid[1:]
    last[bounds[1:][bounds[1:] > 0] - 1] = True
    starts, ends = np.flatnonzero(solid & first), np.flatnonzero(solid & last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(texts: pa.Array, bare: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each text's words, A-Z lower-cased, and each text's bounds among them.

    Long texts are cut at white space and worked through in pieces, so besides the hashes a piece's arrays are held.
    """
    data, bounds = joined_bytes(texts)
    found, places, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(data):
        to = _next_space(data, at + PIECE_BYTES)
        inside = bounds[(bounds > at) & (bounds < to)] - at
        starts, ends, _ = words(data[at:to], np.concatenate([[0], inside, [to - at]]), bare)
        found.append(PrefixHash(data[at:to], folded=True).of(starts, ends))
        places.append(starts + at)
        at = to
    return np.concatenate(found), np.searchsorted(np.concatenate(places), bounds)


def _next_space(data: np.ndarray, at: int) -> int:
    """The first place of white space from there on, or the end."""
    while at < len(data):
        gap = np.flatnonzero(_SPACE[data[at : at + _BLOCK]])
        if len(gap):
            return at + int(gap[0])
        at += _BLOCK
    return len(data)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingles of so many words, as hashes. A text of fewer words is one shingle, or none."""
    hashes, bounds = word_hashes(texts)
    windows = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        windows += mix64(hashes[k : k + len(windows)] + np.uint64(k)) * (_P + np.uint64(2 * k))
    windows = mix64(windows)
    out = []
    for a, b in pairwise(bounds.tolist()):
        if b - a >= size:
            out.append(np.unique(windows[a : b - size + 1]))
        elif b > a:
            short = hashes[a:b] * powers(_P, b - a + 1)[1:]
            out.append(mix64(np.array([short.sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
        else:
            out.append(windows[:0])
    return out
