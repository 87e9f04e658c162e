"""Vectorised words and word hashes over Arrow text columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. UTF-8 never uses those
bytes inside a longer character, so working on bytes gives the same words as working on
characters. Texts are taken in pieces of about ``PIECE`` bytes, cut at white space, so a
very long text needs no more memory than its word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18

_rng = np.random.default_rng(20240229)
_VAL = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 3
_BASE_INV = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VAL_LOWER = _VAL[LOWER]

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE + 4096)
        for i, b in enumerate((_BASE, _BASE_INV)):
            t = np.full(size, b & (2**64 - 1), np.uint64)
            t[0] = 1
            _powers[i] = np.cumprod(t, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + n + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def doc_ranges(off: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of whole texts of about ``limit`` bytes (one text at least)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def _piece_words(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word of the texts that ``off`` cuts out of ``b``."""
    w = ~SPACE[b]
    if not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(b) + 1, bool)
    edge[off] = True
    before = np.empty(len(b), bool)  # the byte before is no part of the same word
    before[0] = True
    np.logical_not(w[:-1], out=before[1:])
    before |= edge[:-1]
    after = np.empty(len(b), bool)
    after[-1] = True
    np.logical_not(w[1:], out=after[:-1])
    after |= edge[1:]
    return np.flatnonzero(w & before), np.flatnonzero(w & after) + 1


def _piece_hashes(b: np.ndarray, s: np.ndarray, e: np.ndarray, lower: bool) -> np.ndarray:
    p, inv = _power_tables(len(b) + 1)
    c = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((_VAL_LOWER if lower else _VAL)[b] * p[: len(b)], out=c[1:])
    return mix((c[e] - c[s]) * inv[s] + (e - s).astype(np.uint64))


def _cuts(b: np.ndarray) -> list[int]:
    """Where to cut one long text: after white space, about every ``PIECE`` bytes."""
    cuts = [0]
    while len(b) - cuts[-1] > PIECE:
        lo = cuts[-1]
        back = np.flatnonzero(SPACE[b[lo : lo + PIECE]])
        if len(back):
            cuts.append(lo + int(back[-1]) + 1)
            continue
        hi = lo + PIECE
        while hi < len(b) and not SPACE[b[hi]]:
            step = np.flatnonzero(SPACE[b[hi : hi + PIECE]])
            hi = hi + int(step[0]) if len(step) else min(len(b), hi + PIECE)
        if hi >= len(b):
            break
        cuts.append(hi + 1)
    return [*cuts, len(b)]


def words(
    b: np.ndarray, off: np.ndarray, lower: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, first word of each text) over a range of texts; word starts and
    ends are byte positions in ``b``. ``lower`` folds A-Z before hashing."""
    if len(off) == 2 and len(b) > PIECE:
        cuts = _cuts(b)
        hs, ss, es = [], [], []
        for lo, hi in zip(cuts, cuts[1:]):
            s, e = _piece_words(b[lo:hi], np.array([0, hi - lo]))
            hs.append(_piece_hashes(b[lo:hi], s, e, lower))
            ss.append(s + lo)
            es.append(e + lo)
        h, s, e = np.concatenate(hs), np.concatenate(ss), np.concatenate(es)
        return h, s, e, np.array([0, len(h)])
    s, e = _piece_words(b, off)
    return _piece_hashes(b, s, e, lower), s, e, np.searchsorted(s, off)


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one text; with fewer words, of its whole sequence;
    without words, none."""
    n = len(h)
    if n == 0:
        return h
    m = min(k, n)
    out = np.full(n - m + 1, 0x51ED27 + m, np.uint64)
    for j in range(m):
        out *= np.uint64(_BASE & (2**64 - 1))
        out += h[j : n - m + 1 + j]
    return mix(out)
