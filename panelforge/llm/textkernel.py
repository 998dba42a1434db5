"""Vectorised numpy kernels over batches of texts: words, word hashes, shingles.

Words are the runs of bytes outside space and 0x09-0x0D, with A-Z lower-cased.  Everything runs on the UTF-8
buffers of Arrow batches, a few megabytes at a time; a text is never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_rng = np.random.default_rng(20240117)
_U = np.uint64
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_VALUE[65:91] = _VALUE[97:123]
_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_BASE = _U(0x9E3779B97F4A7C15)
_POW = np.ones(64, np.uint64)
SHINGLE = 5
_MUL = _rng.integers(1, 2**63, SHINGLE + 2, dtype=np.uint64) * _U(2) + _U(1)


def _powers(n: int) -> np.ndarray:
    global _POW
    if len(_POW) < n or _POW[1] == 1:
        p = np.full(max(n, 64), _BASE, np.uint64)
        p[0] = 1
        _POW = np.cumprod(p, dtype=np.uint64)
    return _POW


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def chunks(off: np.ndarray, limit: int = CHUNK):
    """Ranges ``(i, j)`` of texts holding about ``limit`` bytes, at least one text each."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(raw: np.ndarray, off: np.ndarray, sep: np.ndarray = _SEP):
    """``(start, end, hash, first)``: byte range and hash of each word; ``first[d]`` counts the words before text d.
    ``sep`` marks the bytes between words."""
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    inside = ~sep[raw]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    left = np.empty(n, bool)
    left[0], left[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~left | cut[:-1]))
    right = np.empty(n, bool)
    right[-1], right[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & (~right | cut[1:])) + 1
    first = np.searchsorted(start, off)
    if not len(start):
        return start, end, np.zeros(0, np.uint64), first
    size = end - start
    power = _powers(int(size.max()) + 1)
    reach = np.diff(np.append(start, n))
    place = np.arange(start[0], n) - np.repeat(start, reach)
    np.minimum(place, len(power) - 1, out=place)
    value = np.where(sep, _U(0), _VALUE)
    h = np.add.reduceat(value[raw[start[0]:]] * power[place], start - start[0])
    return start, end, mix(h ^ size.astype(np.uint64)), first


_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_UP = _DOWN = np.ones(0, np.uint64)


def tokens(raw: np.ndarray, off: np.ndarray, sep: np.ndarray = _SEP):
    """The same as :func:`words`, for chunks that fit the processor's cache: hashes are differences of one running sum over all
    bytes, weighted by powers of the place, times the inverse power of the word's start."""
    global _UP, _DOWN
    n = len(raw)
    if len(_UP) < n:
        _UP, _DOWN = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1 << 17), b, np.uint64)])) for b in (_BASE, _INVERSE))
    inside = ~sep[raw]
    cut = off[(off > 0) & (off < n)]
    left, right = np.zeros(n, bool), np.zeros(n, bool)
    left[1:], right[:-1] = inside[:-1], inside[1:]
    left[cut], right[cut - 1] = False, False
    start, end = np.flatnonzero(inside & ~left), np.flatnonzero(inside & ~right) + 1
    value = np.where(sep, _U(0), _VALUE)[raw]
    value *= _UP[:n]
    np.cumsum(value, out=value)
    h = np.diff(value[end - 1], prepend=_U(0))
    h *= _DOWN[start]
    return start, end, mix(h ^ (end - start).astype(np.uint64)), np.searchsorted(start, off)


def shingle_sets(column):
    """Yields ``(i, set)`` for each text i: the sorted distinct hashes of its 5-word shingles (one for the whole
    sequence of a shorter text, none without words)."""
    raw, off = utf8(column)
    for i, j in chunks(off):
        _, _, h, first = words(raw[off[i]:off[j]], off[i:j + 1] - off[i])
        s = None
        if len(h) >= SHINGLE:
            n = len(h) - SHINGLE + 1
            s = h[:n] * _MUL[0]
            for k in range(1, SHINGLE):
                s += h[k:k + n] * _MUL[k]
            s = mix(s)
        for d in range(i, j):
            a, b = int(first[d - i]), int(first[d - i + 1])
            if b - a >= SHINGLE:
                x = np.sort(s[a:b - SHINGLE + 1])
                yield d, x[np.append(True, x[1:] != x[:-1])]
            elif b > a:
                yield d, mix((h[a:b] * _MUL[:b - a]).sum(dtype=np.uint64, keepdims=True) + _MUL[SHINGLE:SHINGLE + 1] * _U(b - a))
            else:
                yield d, h[:0]
