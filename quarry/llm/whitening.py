"""Whitening of embedding vectors: distributed centred covariance, leading eigenpairs, broadcast projection.

An entry c counts as the whole number floor(64 c) + 1000000 (``scale`` and ``shift``; beyond 64 bits it is taken as the
nearest that fits), so sums are exact at any order of the tasks. Passes over the table:

1. count and sums of every dimension: exact whole numbers;
2. covariance: each task centres its vectors by the mean and adds up their products, and Spark adds up the cells of the
   tasks' matrices, so that no task or group holds more than one matrix;
3. the eigenpairs of that matrix (its size is the dimension's square, whatever the number of rows; ``eigen``) are
   broadcast, and the covariance of the whitened vectors, centred in the same way, measures the error;
4. the whitened vectors.

What comes back to the driver are a few numbers for each dimension and the matrices, for ``MAX_DIMENSION`` at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import eigen
from quarry.llm.sketch import Shared

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
MAX_DIMENSION = 2048
#: Eigenvalues up to this part of the largest are taken as zero: along their vectors there is nothing to whiten.
NO_VARIANCE = 1e-9
_EDGE = 9.2e18
_SMALL = 1 << 40
_LOW_BITS = 31


def _whole(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the list column with so many entries, all of them finite, and the whole numbers of these entries."""
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), dimension), False).to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    finite = np.isfinite(flat).all(1)
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(SCALE * flat[finite]), -_EDGE, _EDGE)
    return rows[finite], x.astype(np.int64) + SHIFT


def _exact(x: np.ndarray) -> np.ndarray:
    """``x``, as Python's numbers if products and sums of it could pass 64 bits."""
    return x if not x.size or max(x.max(), -x.min()) < _SMALL else x.astype(object)


@dataclass
class Centre:
    """Number of vectors and sums of the dimensions; the mean is ``whole`` + ``rest`` / n."""

    n: int
    whole: list[int]
    rest: list[int]

    def dimension(self) -> int:
        return len(self.whole)

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array(self.whole, object)
        near = _exact(x) - (whole if x.dtype == object or max(map(abs, self.whole)) >= _SMALL else whole.astype(np.int64))
        return near.astype(np.float64) - np.array(self.rest, np.float64) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - sum)**2, exactly; None if it passes 64 bits."""
        near = x.astype(object) - np.array(self.whole, object)
        most = int(np.abs(near).max(initial=0))
        if self.dimension() * (self.n * (most + 1)) ** 2 < 1 << 63:
            own = near.astype(np.int64) * self.n - np.array(self.rest, np.int64)
        else:
            own = near * self.n - np.array(self.rest, object)
        return [v if v < 1 << 63 else None for v in map(int, (own * own).sum(1))]


@dataclass
class Projection:
    centre: Centre
    axes: np.ndarray  # dimension x components, each eigenvector over the root of its eigenvalue
    explained: np.ndarray
    whitened_mean: np.ndarray
    error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.axes


def _centre(vectors: DataFrame) -> Centre | None:
    """Of the vectors of the most frequent length (the larger of equally frequent ones); None if there are none."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            column = batch.column(0)
            for d in pc.unique(pc.list_value_length(column)).drop_null().to_pylist():
                if d:
                    rows, x = _whole(column, d)
                    n, total = totals.get(d, (0, np.zeros(d, object)))
                    totals[d] = n + len(rows), total + _exact(x).sum(0).astype(object) if len(rows) else total
        for d, (n, total) in totals.items():
            low = [int(v) & ((1 << _LOW_BITS) - 1) for v in total]
            high = [int(v) >> _LOW_BITS for v in total]
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), *(pa.array(v, pa.int64()) for v in ([n] * d, high, low))], ["d", "i", "n", "high", "low"])

    sums = vectors.mapInArrow(add, "d int, i int, n bigint, high bigint, low bigint").groupBy("d", "i").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low")))
    frequent = sums.filter("i = 0 and n > 0").orderBy(F.desc("n"), F.desc("d")).select("d").head()
    if frequent is None:
        return None
    if frequent[0] > MAX_DIMENSION:
        raise ValueError(f"vectors of more than {MAX_DIMENSION} entries")
    found = sorted(sums.filter(F.col("d") == frequent[0]).collect(), key=lambda r: r["i"])
    n, total = found[0]["n"], [(r["high"] << _LOW_BITS) + r["low"] for r in found]
    return Centre(n, [s // n for s in total], [s % n for s in total])


def _covariance(vectors: DataFrame, d: int, k: int, centred) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the products of ``centred(vectors)`` (k x k) and of themselves (k)."""
    upper = np.triu_indices(k)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, own = np.zeros((k, k)), np.zeros(k)
        some = False
        for batch in batches:
            rows, x = _whole(batch.column(0), d)
            if len(rows):
                y = centred(x)
                products += y.T @ y
                own += y.sum(0)
                some = True
        if some:
            cells, values = np.concatenate([upper[0] * k + upper[1], k * k + np.arange(k)]), np.concatenate([products[upper], own])
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(values)], ["cell", "v"])

    cells = vectors.mapInArrow(multiply, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    flat = np.zeros(k * k + k)
    flat[cells["cell"].to_numpy()] = cells["v"].to_numpy()
    half = flat[: k * k].reshape(k, k)
    return half + np.triu(half, 1).T, flat[k * k :]


def fit(table: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Projection | None:
    """Mean, leading components and the measured error of the whitened covariance; None if no vector remains."""
    vectors = table.select(F.col(vec_col).alias("v"))
    spark = table.sparkSession
    centre = _centre(vectors)
    if centre is None:
        return None
    d = centre.dimension()
    centre_of = Shared(spark, centre)
    products, left = _covariance(vectors, d, d, lambda x: centre_of.value.centred(x))
    matrix = products / centre.n
    values, axes = eigen.leading(matrix, components)
    used = values > NO_VARIANCE * max(values.max(initial=0.0), 0.0)
    values, axes = values[used], axes[:, used]
    axes = axes / np.sqrt(values)
    found = Projection(centre, axes, values / np.trace(matrix) if len(values) else values, (left / centre.n) @ axes)
    if len(values):
        shared = Shared(spark, found)
        again, _ = _covariance(vectors, d, len(values), lambda x: shared.value.whitened(x) - shared.value.whitened_mean)
        found.error = float(np.abs(again / centre.n - np.eye(len(values))).max())
    return found


def whiten(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component (numbered from 1, by falling variance): id, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``.

    Vectors that are null or hold a null, NaN or infinite entry are dropped, and so are those of another length than the
    most frequent one (of equally frequent lengths, the larger). Repeated rows are kept and count as often as they
    occur; ids may be null or repeat. Components without variance (at most ``NO_VARIANCE`` of the largest) are left out:
    a single vector, or equal vectors only, give an empty result, and so does an empty table. ``deviation`` is null
    where it passes 64 bits. Other columns are ignored.
    """
    found = fit(table, vec_col, components)
    rows = table.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    k = len(found.explained) if found is not None else 0
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kinds = [T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *map(T.StructField, names, kinds)])
    shared = Shared(table.sparkSession, found)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows if k else 0, 2_000):
                piece = batch.slice(lo, 2_000)
                use: Projection = shared.value
                at, x = _whole(piece.column(1), use.centre.dimension())
                again = np.repeat(np.arange(len(at)), k)
                deviation = pa.array(use.centre.deviation(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(pa.array(at[again])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(len(again), use.centre.n)), deviation.take(pa.array(again)),
                        pa.array(use.whitened(x).ravel()), pa.array(np.tile(use.explained, len(at))), pa.array(np.full(len(again), use.error)),
                    ],
                    [f.name for f in schema],
                )

    return rows.mapInArrow(project, schema).withColumnRenamed("id", id_col)
