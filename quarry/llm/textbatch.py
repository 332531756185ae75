"""Whole texts of an Arrow batch as numpy arrays: words, lines and hashes of spans.

A text is its UTF-8 bytes. Several texts are worked on at once (``chunks``), so that the arrays stay long enough
for numpy and bounded in memory: a chunk ends after ``CHUNK_BYTES`` bytes, or holds one longer text.

Span hashes are 64-bit polynomial hashes over prefix sums, finished with a bit mixer. They serve to find equal
spans; operators state where a collision could matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 250_000

#: The six bytes that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer on uint64 (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        out = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            out.append(np.cumprod(table, dtype=np.uint64))
        _powers, _inverses = out
    return _powers, _inverses


class Spans:
    """Hashes of any span [start, end) of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray) -> None:
        power, self._inverse = _tables(len(values) + 1)
        self._prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[: len(values)], out=self._prefix[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix((self._prefix[end] - self._prefix[start]) * self._inverse[start] + length * np.uint64(0xD6E8FEB86659FD93))

    def windows(self, width: int) -> np.ndarray:
        """Hash of every span of ``width`` values."""
        n = len(self._prefix) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._prefix[width:] - self._prefix[:n]) * self._inverse[:n] + np.uint64(width * 0xD6E8FEB86659FD93 & _MASK))


class Chunk:
    """Some texts of a batch: bytes of all of them, ``offsets`` of each (one more than texts), ``rows`` in the batch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int) -> None:
        self.data, self.offsets, self.first = data, offsets, first
        self.rows = np.arange(first, first + len(offsets) - 1)

    def byte_spans(self) -> Spans:
        return Spans(_BYTE[self.data])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word; for each text the number of its first word (one more than texts)."""
        inside = IS_WORD[self.data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edge = self.offsets[(self.offsets > 0) & (self.offsets < len(inside))]
        begins[edge] = inside[edge]
        ends[edge - 1] = inside[edge - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        return start, end, np.searchsorted(start, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each line (the pieces between line feeds; an empty text has one empty line); first line of each text."""
        feeds = np.flatnonzero(self.data == 0x0A)
        before = np.searchsorted(feeds, self.offsets)
        first = before + np.arange(len(self.offsets))
        n = len(feeds) + len(self.rows)
        start, end = np.empty(n, np.int64), np.empty(n, np.int64)
        at = np.arange(len(feeds)) + np.searchsorted(self.offsets[1:], feeds, "right")
        start[first[:-1]] = self.offsets[:-1]
        start[at + 1] = feeds + 1
        end[first[1:] - 1] = self.offsets[1:]
        end[at] = feeds
        return start, end, first


def chunks(column: pa.Array, size: int | None = None) -> Iterator[Chunk]:
    """Cut a string or binary column into chunks of whole texts; a null is an empty text."""
    size = size or CHUNK_BYTES
    binary = column.cast(pa.large_binary())
    if binary.null_count:
        binary = pc.fill_null(binary, b"")
    offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1] if len(binary) else np.zeros(1, np.int64)
    raw = binary.buffers()[2] if len(binary) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(binary):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield Chunk(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lo)
        lo = hi


def owner(first: np.ndarray) -> np.ndarray:
    """For each part its text, from the number of the first part of each text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def inside(first: np.ndarray, width: int) -> np.ndarray:
    """Which spans of ``width`` consecutive parts lie in one text (one flag for every such span of the whole chunk)."""
    n = int(first[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    left = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n)
    return left >= width


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of True."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def slide(values: np.ndarray, width: int, of=np.minimum) -> np.ndarray:
    """Minimum (or maximum) of every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = of(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def cover(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Flags of the n positions that some span [start, end) covers."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0
