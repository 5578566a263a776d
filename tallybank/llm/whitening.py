"""Whitening of embeddings: coordinates along the leading principal components, each scaled to variance one.

Sums and products are gathered in tasks and added up by Spark; only what a matrix of dimension by dimension holds reaches
the driver, where spectrum slicing finds its leading eigenpairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.llm.common import arrow_schema
from tallybank.llm.spectrum import leading

COMPONENTS = 32
#: Grid of the whole numbers: x = floor(STEPS * c) + OFFSET.
STEPS, OFFSET = 64, 1_000_000
#: Vectors longer than this are refused, as products of all pairs of dimensions are held by each task and the driver.
MAX_DIMENSIONS = 4096
#: Eigenvalues at most this part of the trace are taken for zero: rounding alone makes such values.
RANK_TOLERANCE = 1e-11
_ROWS = 4096
_LONG = 2 ** 63 - 1


def vectors_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x): for each length of vector in the column, the places of its vectors and their whole numbers. Null vectors
    and those with null or non-finite entries are left out, as are empty ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0), dtype=np.int64)
    values = np.asarray(pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = (lengths > 0) & (bad[starts[1:]] == bad[starts[:-1]])
    for length in np.unique(lengths[good]).tolist():
        rows = np.flatnonzero(good & (lengths == length))
        with np.errstate(over="ignore"):
            steps = np.floor(STEPS * values[starts[rows][:, None] + np.arange(length)])
        yield rows, np.clip(steps, -2.0 ** 62, 2.0 ** 62).astype(np.int64) + OFFSET


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            yield whole.slice(at, _ROWS)


def _whole_sums(x: np.ndarray) -> list[int]:
    """Exact column sums as Python integers: high and low halves can't overflow."""
    high, low = x >> 32, x & 0xFFFFFFFF
    return [(int(h) << 32) + int(w) for h, w in zip(high.sum(axis=0), low.sum(axis=0), strict=True)]


@dataclass
class Fit:
    """What the fit list gives: number of vectors, sums by dimension, and the components."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def base(self) -> np.ndarray:
        """The whole number nearest to each mean; what is left of the mean is `rest` / n."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        return [s - self.n * int(b) for s, b in zip(self.sums, self.base, strict=True)]


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number and exact sums of the vectors of the most frequent length (of equally frequent ones the longest)."""
    schema = T.StructType([T.StructField("length", T.IntegerType()), T.StructField("place", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("total", T.DecimalType(38, 0))])
    kinds = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            for rows, x in vectors_of(batch.column(0)):
                d = x.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()),
                                                  pa.array([len(rows)] * d, pa.int64()),
                                                  pa.array([Decimal(s) for s in _whole_sums(x)], pa.decimal128(38, 0))], schema=kinds)

    made = vectors.mapInArrow(run, schema).groupBy("length", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    # One row for each length, so the sums of all dimensions come with the choice of the length.
    by_length = made.groupBy("length").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "total"))).alias("sums"))
    first = by_length.orderBy(F.desc("n"), F.desc("length")).take(1)
    return (first[0]["n"], [int(s["total"]) for s in first[0]["sums"]]) if first else (0, [])


def _products(vectors: DataFrame, size: int, rows_of) -> tuple[np.ndarray, np.ndarray]:
    """(sum of y, sum of y yᵀ) over rows y = rows_of(x); each task adds up its own before anything moves."""
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(size), np.zeros((size, size))
        for batch in _batches(batches):
            for _, x in vectors_of(batch.column(0)):
                if (y := rows_of(x)) is not None:
                    total += y.sum(axis=0)
                    products += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.full(size, -1), upper[0]]).astype(np.int32)),
                                          pa.array(np.concatenate([np.arange(size), upper[1]]).astype(np.int32)),
                                          pa.array(np.concatenate([total, products[upper]]))], names=["a", "b", "s"])

    got = vectors.mapInArrow(run, "a int, b int, s double").groupBy("a", "b").agg(F.sum("s").alias("s")).toArrow()
    a, b, s = (got.column(i).to_numpy() for i in range(3))
    total, products = np.zeros(size), np.zeros((size, size))
    single = a < 0
    total[b[single]] = s[single]
    products[a[~single], b[~single]] = products[b[~single], a[~single]] = s[~single]
    return total, products


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Fit:
    """Means and leading components over all usable vectors.

    Vectors are centred at whole numbers next to the means, so products and their sums are exact in doubles below 2^53; the
    remaining fractions of the means are taken off afterwards.
    """
    only = vectors.select(F.col(f"`{column}`"))
    n, sums = _sums(only)
    size = len(sums)
    if size > MAX_DIMENSIONS:
        raise ValueError(f"{size} dimensions; {MAX_DIMENSIONS} at most")
    found = Fit(n, sums, np.empty(0), np.empty((size, 0)), 0.0)
    if not n:
        return found
    base, rest = found.base, np.array([r / n for r in found.rest])
    _, products = _products(only, size, lambda x: (x - base).astype(np.float64) if x.shape[1] == size else None)
    covariance = products / n - np.outer(rest, rest)
    found.trace = float(np.trace(covariance))
    found.values, found.vectors = leading(covariance, components, RANK_TOLERANCE * found.trace)
    return found


def _projector(found: Fit):
    """Function from whole numbers to whitened coordinates; None for vectors of another length."""
    size, base, rest = len(found.sums), found.base, np.array([r / found.n for r in found.rest])
    scaled = found.vectors / np.sqrt(found.values)
    return lambda x: ((x - base).astype(np.float64) - rest) @ scaled if x.shape[1] == size else None


def _deviations(x: np.ndarray, found: Fit) -> list[int]:
    """Exact sums over dimensions of (n x - S)^2."""
    y, rest = x - found.base, found.rest
    most = found.n * (int(np.abs(y).max(initial=0)) + 1)
    if most * most * x.shape[1] <= _LONG:
        off = found.n * y - np.array(rest, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    off = found.n * y.astype(object) - np.array(rest, dtype=object)
    return (off * off).sum(axis=1).tolist()


def identity_error(vectors: DataFrame, found: Fit, column: str = "embedding") -> float:
    """Largest absolute entry of the covariance of all whitened vectors minus the identity, measured on the rows."""
    size = len(found.values)
    total, products = _products(vectors.select(F.col(f"`{column}`")), size, _projector(found))
    mean = total / found.n
    return float(np.abs(products / found.n - np.outer(mean, mean) - np.eye(size)).max())


def whiten(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, deviation_exact): one row for each usable vector and
    leading component.

    Vectors that are null, empty or hold null or non-finite entries are left out, as are those of another length than the
    most frequent one. Entries beyond the range of whole numbers stay at its ends. Components with an eigenvalue of zero
    (fewer vectors than dimensions, constant columns) have no whitened coordinate and no rows; equal eigenvalues get
    orthogonal vectors of their common space. `deviation` is null where it exceeds 64 bits, `deviation_exact` beyond 38
    digits. Ids may be null or repeated; other columns aren't read. An empty table gives an empty result.
    """
    found = fit(vectors, column, components)
    schema = T.StructType([T.StructField(id_column, vectors.schema[id_column].dataType), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType()), T.StructField("deviation_exact", T.DecimalType(38, 0))])
    k = len(found.values)
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    error, explained, kinds = identity_error(vectors, found, column), found.values / found.trace, arrow_schema(schema)
    project = _projector(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            for rows, x in vectors_of(batch.column(1)):
                if (made := project(x)) is None:
                    continue
                exact = _deviations(x, found)
                per_row = pa.array(np.repeat(np.arange(len(rows)), k))
                count = len(rows) * k
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows[np.repeat(np.arange(len(rows)), k)])).cast(kinds.field(0).type),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(count, found.n)),
                    pa.array([e if e <= _LONG else None for e in exact], pa.int64()).take(per_row),
                    pa.array(made.ravel()), pa.array(np.tile(explained, len(rows))), pa.array(np.full(count, error)),
                    pa.array([Decimal(e) if e < 10 ** 38 else None for e in exact], pa.decimal128(38, 0)).take(per_row)], schema=kinds)

    return vectors.select(F.col(f"`{id_column}`"), F.col(f"`{column}`")).mapInArrow(run, schema)
