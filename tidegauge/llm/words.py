"""Words of many texts at once: spans, 64-bit word hashes and hashes of word windows, in numpy.

Texts come as Arrow string columns; nothing here makes a Python object per word. Words are maximal
runs of bytes other than space and TAB..CR, so every function sees the words of ``bytes.split()``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidegauge.llm.xx64 import digests

#: Bytes of text that are worked on together.
CHUNK = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_BYTES = np.random.default_rng(20).integers(1, 2**64, 256, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


_tables: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    table = _tables.get(base)
    if table is None or len(table) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        table = np.full(size, base, np.uint64)
        table[0] = 1
        _tables[base] = table = np.cumprod(table, dtype=np.uint64)
    return table[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """The hash of values[start:end] for each pair: equal runs give equal hashes, wherever they stand."""
    n = len(values)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * powers(base, n), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(inverse(base), n + 1)[starts]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offset of each text, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.empty(0, np.uint8)
    return data, (offsets - offsets[0] if len(column) else np.zeros(1, np.int64))


def slices(batch: pa.RecordBatch, text: str, size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text each, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    _, offsets = text_bytes(column)
    at, n = 0, len(column)
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, min(end, n) - at)
        at = end


class Words:
    """The words of a column of texts: ``starts``, ``ends`` (bytes), and ``first``: where each text's words begin."""

    def __init__(self, column: pa.Array, lower: bool = False) -> None:
        self.data, self.offsets = text_bytes(column)
        if lower:
            upper = (self.data >= 65) & (self.data <= 90)
            self.data = self.data + (upper * np.uint8(32)).astype(np.uint8)
        solid = ~SPACE[self.data]
        before = np.empty_like(solid)
        before[1:] = solid[:-1]
        begins = self.offsets[:-1][self.offsets[:-1] < len(solid)]
        before[:1] = False
        before[begins] = False
        self.starts = np.flatnonzero(solid & ~before)
        after = np.empty_like(solid)
        after[:-1] = solid[1:]
        after[-1:] = False
        lasts = self.offsets[1:] - 1
        after[lasts[lasts >= 0]] = False
        self.ends = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        return mixed(runs(_BYTES[self.data], self.starts, self.ends, _BYTE_BASE) + (self.ends - self.starts).astype(np.uint64))

    def digests(self, seed: int) -> np.ndarray:
        """XXH64 of each word: what no texts can be made to share, and independent for each seed."""
        return digests(self.data.tobytes(), self.starts, self.ends - self.starts, seed)

    def text_of_word(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def windows(hashes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """The hash of ``length`` consecutive words from each position on; ``which`` picks one of two hash functions."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    at = np.arange(n)
    values = hashes if not which else mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))
    return mixed(runs(values, at, at + length, _WORD_BASE[which]))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` consecutive values from each position on."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (length of them) for each pair, one after the other."""
    total = int(lengths.sum())
    out = np.ones(total, np.int64)
    lengths, starts = lengths[lengths > 0], starts[lengths > 0]
    if not total:
        return out
    heads = np.cumsum(lengths) - lengths
    out[heads] = starts
    out[heads[1:]] -= starts[:-1] + lengths[:-1] - 1
    return np.cumsum(out)
