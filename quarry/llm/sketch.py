"""Count-min sketches merged from partitions, reduced to bitmaps that are small enough to broadcast.

A sketch has ``depth`` rows of 2**log2_cells counters. Each task sends its counts of used cells, cut into parts of
the cell range; the parts are added up by shuffle, and only one bit a cell comes back to the driver (has the count
reached ``at_least``?), so at most ``depth * 2**MAX_LOG2_CELLS / 8`` bytes at any input size. A count is never too
low, so a hash that occurs ``at_least`` times is always found; a larger input than the sketch was made for only
finds more than that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_LOG2_CELLS, MAX_LOG2_CELLS = 16, 30
LOG2_PARTS = 6
#: Jobs at most that bring a sketch to the driver, a share in each.
JOBS = 16
#: Hashes that a task gathers before it sends their counts.
GATHER = 400_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def log2_cells(items: int, cells_an_item: int = 4) -> int:
    """Cells for so many hashes, within the fixed bounds."""
    return max(MIN_LOG2_CELLS, min(MAX_LOG2_CELLS, (max(1, items) * cells_an_item).bit_length()))


class Shared:
    """A broadcast object of a class of this subpackage. Only its plain attributes are broadcast, and the class travels
    with the function that uses it, so executors need not have the package."""

    def __init__(self, spark: SparkSession, value) -> None:
        self._kind, self._value = type(value), None
        self._attributes = None if value is None else spark.sparkContext.broadcast(vars(value))

    @property
    def value(self):
        if self._value is None and self._attributes is not None:
            self._value = object.__new__(self._kind)
            self._value.__dict__.update(self._attributes.value)
        return self._value


class Bitmap:
    """The cells of a sketch that have reached the threshold."""

    def __init__(self, bits: np.ndarray, log2: int) -> None:
        self.bits, self.log2 = bits, log2  # depth x bytes

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for row, bits in enumerate(self.bits):
            cell = _cell(hashes, row, self.log2)
            found &= (bits[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _cell(hashes: np.ndarray, row: int, log2: int) -> np.ndarray:
    x = hashes * _ODD[row]
    return (x ^ (x >> np.uint64(32))) * _ODD[(row + 1) % 3] >> np.uint64(64 - log2)


def _steps(cells: np.ndarray) -> bytes:
    """Rising cells as the steps between them, of two bytes each if all fit, else of four."""
    steps = np.diff(cells, prepend=np.uint32(0))
    return steps.astype(np.uint16 if steps.max(initial=0) < 1 << 16 else np.uint32).tobytes()


def _merged(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterable[np.ndarray]], log2: int, depth: int, cap: int, encode: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Counts (up to ``cap``) of all cells over all rows of ``df``, as ``encode`` packs them into bytes: depth x bytes."""
    low = log2 - LOG2_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []

        def sent() -> Iterator[pa.RecordBatch]:
            own = np.concatenate(waiting) if waiting else np.zeros(0, np.uint64)
            waiting.clear()
            for row in range(depth if len(own) else 0):
                cells, n = np.unique(_cell(own, row, log2), return_counts=True)
                edge = np.searchsorted(cells >> np.uint64(low), np.arange((1 << LOG2_PARTS) + 1))
                inner = (cells & np.uint64((1 << low) - 1)).astype(np.uint32)
                n = np.minimum(n, cap).astype(np.uint16)
                used = np.flatnonzero(np.diff(edge))
                blobs = [[_steps(inner[edge[p] : edge[p + 1]]) for p in used], [n[edge[p] : edge[p + 1]].tobytes() for p in used]]
                yield pa.RecordBatch.from_arrays([pa.array((used + (row << LOG2_PARTS)).astype(np.int32)), *(pa.array(b, pa.binary()) for b in blobs)], ["part", "cells", "n"])

        for batch in batches:
            for h in hashes(batch):
                waiting.append(h)
                if sum(map(len, waiting)) >= GATHER:
                    yield from sent()
        yield from sent()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, cells, n in zip(*(c.to_pylist() for c in batch.columns)):
                total = totals.setdefault(part, np.zeros(1 << low, np.uint16))
                at = np.cumsum(np.frombuffer(cells, np.uint32 if len(cells) > len(n) else np.uint16), dtype=np.int64)
                total[at] = np.minimum(total[at].astype(np.uint32) + np.frombuffer(n, np.uint16), cap)
        for part, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([encode(total).tobytes()], pa.binary())], ["part", "bits"])

    parts = df.mapInArrow(count, "part int, cells binary, n binary").repartition("part").coalesce(JOBS).mapInArrow(merge, "part int, bits binary")
    empty = encode(np.zeros(1 << low, np.uint16))
    out = np.tile(empty, (depth, 1 << LOG2_PARTS, 1))
    for part, own in parts.toLocalIterator():
        out[part >> LOG2_PARTS, part & ((1 << LOG2_PARTS) - 1)] = np.frombuffer(own, np.uint8)
    return out.reshape(depth, -1)


def bitmap(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterable[np.ndarray]], log2: int, at_least: int, depth: int = 1) -> Bitmap:
    """Cells whose count over all rows of ``df`` is ``at_least`` or more; ``hashes`` gives the uint64 hashes of a batch."""
    return Bitmap(_merged(df, hashes, log2, depth, at_least, lambda total: np.packbits(total >= at_least, bitorder="little")), log2)


class Levels:
    """Counts of a sketch of one row, as eight steps to a doubling: 0 for none, 8 for one, 16 for three, up to 128."""

    ONCE = 8

    def __init__(self, steps: np.ndarray, log2: int) -> None:
        self.steps, self.log2, self.most = steps, log2, int(steps.max(initial=0))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self.steps[_cell(hashes, 0, self.log2)]


def levels(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterable[np.ndarray]], log2: int) -> Levels:
    """How often each hash occurs, never too low (up to 65,535), in one byte a cell."""
    return Levels(_merged(df, hashes, log2, 1, 0xFFFF, lambda total: (8 * np.log2(1.0 + total)).astype(np.uint8))[0], log2)


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0


def split_by_key(rows: DataFrame, keys: DataFrame, key_col: str = "key") -> tuple[DataFrame, DataFrame]:
    """Rows whose ``key_col`` (a hash) may be in ``keys``, and those whose key surely isn't, which then need no join with it."""
    found = bitmap(keys, lambda batch: [signed_hashes(batch.column(0))], log2_cells(keys.count(), 16), 1)
    shared = Shared(rows.sparkSession, found)
    at = rows.columns.index(key_col)

    def kept(batches: Iterator[pa.RecordBatch], side: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.has(signed_hashes(batch.column(at))) == side))

    return rows.mapInArrow(lambda b: kept(b, True), rows.schema), rows.mapInArrow(lambda b: kept(b, False), rows.schema)


def signed_hashes(column: pa.Array) -> np.ndarray:
    """A bigint column without nulls as uint64."""
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)
