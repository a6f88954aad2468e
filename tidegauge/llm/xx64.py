"""XXH64 of many byte spans at once.

The published hash function, written over arrays: a step works on all spans that still have bytes for it.
"""

from __future__ import annotations

import numpy as np
import xxhash

# Fixed values of XXH64: its five primes.
P1, P2, P3, P4, P5 = (
    np.uint64(0x9E3779B185EBCA87),
    np.uint64(0xC2B2AE3D27D4EB4F),
    np.uint64(0x165667B19E3779F9),
    np.uint64(0x85EBCA77C2B2AE63),
    np.uint64(0x27D4EB2F165667C5),
)

#: Longer spans are hashed one by one.
LONG = 256


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _loads(data: bytes, kind: str) -> np.ndarray:
    """The little-endian number that begins at each byte."""
    size = np.dtype(kind).itemsize
    return np.ndarray((len(data) - size + 1,), kind, data, strides=(1,))


def digests(data: bytes, starts: np.ndarray, lengths: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of data[start:start + length] for each pair, as unsigned 64-bit numbers."""
    n = len(starts)
    data = data + bytes(8)
    eights, fours, ones = _loads(data, "<u8"), _loads(data, "<u4"), np.frombuffer(data, np.uint8)
    at, left = starts.astype(np.int64), lengths.astype(np.int64)
    h = np.full(n, (seed + int(P5)) % (1 << 64), np.uint64)
    long = np.flatnonzero(left > LONG)
    wide = np.flatnonzero((left >= 32) & (left <= LONG))
    if len(wide):
        _stripes(eights, at, left, h, wide, seed)
    h += lengths.astype(np.uint64)
    left[long] = 0
    rows = np.flatnonzero(left >= 8)
    while len(rows):
        k = _turned(eights[at[rows]] * P2, 31) * P1
        h[rows] = _turned(h[rows] ^ k, 27) * P1 + P4
        at[rows] += 8
        left[rows] -= 8
        rows = rows[left[rows] >= 8]
    rows = np.flatnonzero(left >= 4)
    if len(rows):
        h[rows] = _turned(h[rows] ^ (fours[at[rows]].astype(np.uint64) * P1), 23) * P2 + P3
        at[rows] += 4
        left[rows] -= 4
    rows = np.flatnonzero(left >= 1)
    while len(rows):
        h[rows] = _turned(h[rows] ^ (ones[at[rows]].astype(np.uint64) * P5), 11) * P1
        at[rows] += 1
        left[rows] -= 1
        rows = rows[left[rows] >= 1]
    h ^= h >> np.uint64(33)
    h *= P2
    h ^= h >> np.uint64(29)
    h *= P3
    h ^= h >> np.uint64(32)
    for i in long.tolist():
        s = int(starts[i])
        h[i] = xxhash.xxh64_intdigest(data[s : s + int(lengths[i])], seed)
    return h


def _stripes(eights: np.ndarray, at: np.ndarray, left: np.ndarray, h: np.ndarray, rows: np.ndarray, seed: int) -> None:
    """The part of 32 bytes at a time; advances ``at`` and ``left`` and sets ``h`` for ``rows``."""
    whole = 1 << 64
    first = [(seed + int(P1) + int(P2)) % whole, (seed + int(P2)) % whole, seed % whole, (seed - int(P1)) % whole]
    lanes = np.array(first, np.uint64)[:, None].repeat(len(rows), 1)
    todo = np.arange(len(rows))
    while len(todo):
        here = rows[todo]
        for lane in range(4):
            lanes[lane, todo] = _turned(lanes[lane, todo] + eights[at[here] + 8 * lane] * P2, 31) * P1
        at[here] += 32
        left[here] -= 32
        todo = todo[left[here] >= 32]
    total = _turned(lanes[0], 1) + _turned(lanes[1], 7) + _turned(lanes[2], 12) + _turned(lanes[3], 18)
    for lane in range(4):
        total = (total ^ (_turned(lanes[lane] * P2, 31) * P1)) * P1 + P4
    h[rows] = total
